"""End-to-end plans: compositions, the text-record path, file jobs and the
registered query catalogue with its SQL oracle."""
