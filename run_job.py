"""spark-submit entry for the file-to-file jobs.

    zip -r blotter.zip blotter
    spark-submit --py-files blotter.zip run_job.py count hdfs:///crimes.csv hdfs:///out
"""

import sys

from blotter.plans.jobs import main

if __name__ == "__main__":
    sys.exit(main())
