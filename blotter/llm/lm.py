"""Language-model scores from a bigram model of the whole corpus, held in
Elias-Fano tries.

Tokens are the lower-cased words of a text and one end. With ``c`` the counts
over the training documents (``crc32`` of the id modulo 7 is not 2), ``N`` all
training tokens and ``V`` the distinct ones:

* ``P(w) = (c(w) + 1) / (N + V + 1)``, the base model;
* ``P(w | v) = (c(v, w) + MU * P(w)) / (c(v) + MU)`` for every pair of words,
  however rare: after a context without training tokens that is ``P(w)``. The
  first word's context is the end of a text.

No task can hold the model of a large corpus, so it is one trie for each shard
of the bigrams, and the work goes to the shards:

1. texts are put into blocks; each sends its words' training counts once, and
   gets the corpus counts of its words back;
2. a block scores by itself what needs no bigram count: pairs with a word that
   has no training tokens, whose count is 0. Both words hot (over a thousandth
   of all tokens, so under a thousand words): their at most a million pair
   counts are broadcast;
3. the other pairs go to their shard, each once a block with its count and the
   documents it is in;
4. a shard adds the counts up, builds the trie of its bigrams, looks all pairs
   up and returns sums by document, which are added up per block.

A shard holds about ``SHARD_TOKENS`` tokens: there are as many as the corpus
needs. A context with many tokens is dealt over shards by the next word.

Word identity is a 64-bit hash, within a context 40 bits of it. Probabilities
are quantised to 256 levels of their logarithm, in the trie and for the
unigram part that travels with a pair.

Defined cases: a null text is empty and has the end alone; a null id is a
training document, and any other id is taken as it is; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import block_body, hashed, saved, word_blocks
from blotter.llm.eliasfano import Trie

MODULUS, HELD = 7, 2
MU = 300.0
HOT_SHARE = 0.001
SHARD_TOKENS = 2_000_000
BLOCK_WORDS = 1 << 20

#: zstandard levels of the blocks, which are written and shuffled whole, and of
#: what goes to the shards and back.
BLOCK_LEVEL, BLOB_LEVEL = 7, 5

END = np.uint64(0x456E64)  # the end token; words are 64-bit hashes
_NEXT_BITS = 40
_UNI_STEP = 1 / 24  # of log10, for the unigram part sent with a pair


def is_held(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % MODULUS == HELD


def to_blob(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers (each as narrow as it can be) or floats."""
    out = []
    for a in arrays:
        if a.dtype.kind != "f":
            top = int(a.max(initial=0))
            a = a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)
        out.append(f"{a.dtype.str}{len(a)};".encode() + a.tobytes())
    return zstandard.ZstdCompressor(level=BLOB_LEVEL).compress(b"".join(out))


def from_blob(blob: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(raw):
        end = raw.index(b";", at)
        kind, n = np.dtype(raw[at : at + 3].decode()), int(raw[at + 3 : end])
        out.append(np.frombuffer(raw, kind, n, end + 1))
        at = end + 1 + n * kind.itemsize
    return out


class Block:
    """The token stream of a block: each text's words and an end."""

    def __init__(self, row: dict):
        lens = np.array(row["lens"], np.int64)
        words = hashed(block_body(row["body"]))
        self.ends = np.cumsum(lens + 1) - 1
        self.starts = self.ends - lens
        tokens = np.full(len(words) + len(lens), END)
        body = np.ones(len(tokens), bool)
        body[self.ends] = False
        tokens[body] = words
        self.ids = row["doc_ids"]
        self.doc = np.repeat(np.arange(len(lens), dtype=np.int32), lens + 1)
        self.n_tokens = lens + 1
        self.held = np.array([is_held(d) for d in self.ids], bool)
        self.words, token = np.unique(tokens, return_inverse=True)
        self.token = token.astype(np.int32)
        self.before = np.roll(self.token, 1)
        self.before[self.starts] = np.searchsorted(self.words, END)
        self.train = ~self.held[self.doc]

    def by_doc(self, weights: np.ndarray, at=slice(None)) -> np.ndarray:
        return np.bincount(self.doc[at], weights=weights, minlength=len(self.ids))


def _dealt(to: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places sorted by ``to`` (under ``n``), and where each value begins."""
    order = np.argsort(to.astype(np.uint16 if n < 1 << 16 else np.uint32), kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(to, minlength=n))])


def _parts(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's words dealt over ``n`` parts by their hash."""
    return _dealt((words % np.uint64(n)).astype(np.int64), n)


def _word_counts(parts: int):
    """Step 1: ``part, block, body``: a block's words of each part, a word
    once, with their training tokens."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                block = Block(row)
                n = np.bincount(block.token[block.train], minlength=len(block.words))
                order, edge = _parts(block.words, parts)
                part = np.flatnonzero(np.diff(edge))
                at = [order[edge[p] : edge[p + 1]] for p in part.tolist()]
                here = np.full(len(part), row["block"], np.int64)
                body = pa.array([to_blob(block.words[x], n[x]) for x in at], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(here), body], ["part", "block", "body"])

    return run


def _corpus_counts(hot_count: float):
    """``block, part, body, types, hot, hot_n``: corpus counts of each block's
    words in the order they came; one row of a part has its number of training
    words, the hot ones and their counts."""

    def run(part: pa.Table) -> pa.Table:
        asked = [from_blob(body) for body in part.column("body").to_pylist()]
        words, place = np.unique(np.concatenate([w for w, _ in asked]).astype(np.uint64), return_inverse=True)
        c = np.bincount(place, weights=np.concatenate([n for _, n in asked]), minlength=len(words)).astype(np.int64)
        edge = np.cumsum([0, *(len(w) for w, _ in asked)])
        more = len(asked) - 1
        return pa.table({
            "block": part.column("block"), "part": part.column("part"),
            "body": pa.array([to_blob(c[place[i:j]]) for i, j in zip(edge, edge[1:])], pa.binary()),
            "types": pa.array([int((c > 0).sum())] + [0] * more, pa.int64()),
            "hot": pa.array([words[c > hot_count].view(np.int64).tolist()] + [[]] * more, pa.list_(pa.int64())),
            "hot_n": pa.array([c[c > hot_count].tolist()] + [[]] * more, pa.list_(pa.int64())),
        })

    return run


def _hot_pairs(hot):
    """``pair, n``: training counts of pairs of hot words (by their places)."""

    def run(batches):
        total = np.zeros(len(hot) ** 2, np.int64)
        for b in batches:
            for row in b.to_pylist():
                block = Block(row)
                place = _places(hot, block.words)
                v, w = place[block.before[block.train]], place[block.token[block.train]]
                both = (v >= 0) & (w >= 0)
                total += np.bincount(v[both] * len(hot) + w[both], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    return run


def _name(words: np.ndarray) -> np.ndarray:
    """What tells words apart behind a context."""
    return words >> np.uint64(64 - _NEXT_BITS)


def _places(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Places of ``x`` among sorted values, -1 where absent."""
    if not len(sorted_values):
        return np.full(len(x), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return np.where(sorted_values[at] == x, at, -1)


def shards(tokens: int) -> int:
    """Shards of the bigrams, and parts of the words."""
    return max(1, round(tokens / SHARD_TOKENS))


class Corpus:
    """What every task knows of the corpus: totals, the hot words and the trie
    of their pairs (as a buffer)."""

    def __init__(self, tokens: int, types: int, hot: np.ndarray):
        self.tokens, self.types, self.hot = tokens, types, hot
        self.shards = shards(tokens)
        self.hot_pairs = b""

    def with_hot_pairs(self, counts: np.ndarray, pair: np.ndarray, n: np.ndarray) -> Corpus:
        """``counts`` of the hot words; ``pair`` numbers with their counts ``n``."""
        v, w = pair // max(1, len(self.hot)), pair % max(1, len(self.hot))
        context, word = self.hot[v], _name(self.hot[w])
        order = np.lexsort((word, context))
        log10p = np.log10((n + MU * self.unigram(counts[w])) / (counts[v] + MU))
        self.hot_pairs = Trie.build(context[order], word[order], log10p[order]).to_bytes()
        return self

    def unigram(self, c: np.ndarray) -> np.ndarray:
        return (c + 1.0) / (self.tokens + self.types + 1)

    def shard(self, context: np.ndarray, c: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Shards of pairs: by the context, and by the next word too for a
        context that would fill more than a quarter of a shard."""
        parts = 1 + (4 * c * self.shards // max(1, self.tokens)).astype(np.uint64)
        x = (context ^ ((word % parts) * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0x9E3779B97F4A7C15)
        return ((x >> np.uint64(32)) % np.uint64(self.shards)).astype(np.int64)


def _probes(shared):
    """Steps 2 and 3: what the block scores by itself, and pairs by shard."""

    def run(key, blocks: pa.Table, counts: pa.Table) -> pa.Table:
        corpus, shard_out, body_out = shared.value, [], []
        hot_pairs = Trie.from_buffer(corpus.hot_pairs)
        for row in blocks.to_pylist():
            block = Block(row)
            c = np.empty(len(block.words), np.int64)
            order, edge = _parts(block.words, corpus.shards)
            for p, body in zip(counts.column("part").to_pylist(), counts.column("body").to_pylist()):
                c[order[edge[p] : edge[p + 1]]] = from_blob(body)[0]
            uni = corpus.unigram(c)
            log_uni = np.log10(uni)
            v, w = block.before, block.token
            base = block.by_doc(log_uni[w])
            score = base.copy()
            hot = _places(corpus.hot, block.words)
            is_hot = hot >= 0
            both_hot = is_hot[v] & is_hot[w]
            at = np.flatnonzero(both_hot)
            # Each pair of hot words once.
            pair, back = np.unique(hot[v[at]] * len(corpus.hot) + hot[w[at]], return_inverse=True)
            first = np.empty(len(pair), np.int64)
            first[back] = at
            x, y = v[first], w[first]
            log10p = hot_pairs.lookup(block.words[x], _name(block.words[y]))
            log10p = np.where(np.isnan(log10p), np.log10(MU * uni[y] / (c[x] + MU)), log10p) - log_uni[y]
            score += block.by_doc(log10p[back], at)
            unseen = (c[v] == 0) | (c[w] == 0)
            at = np.flatnonzero(unseen & ~both_hot)
            score += block.by_doc(np.log10(MU / (c[v[at]] + MU)), at)
            at = np.flatnonzero(~unseen & ~both_hot)
            score -= block.by_doc(log_uni[w[at]], at)
            shard_out.append(_spread(row["block"]) % corpus.shards)
            body_out.append(b"B" + to_blob(
                np.array([d is None for d in block.ids], np.uint8),
                np.array([d or 0 for d in block.ids], np.int64).view(np.uint64), block.held.astype(np.uint8), block.n_tokens, block.by_doc((c > 0)[w].astype(float)).astype(np.int64), base, score,
            ))
            to = corpus.shard(block.words[v[at]], c[v[at]], block.words[w[at]])
            order, edge = _dealt(to, corpus.shards)
            at = at[order]
            codes = np.rint(-log_uni / _UNI_STEP).astype(np.int64)
            for s in np.flatnonzero(np.diff(edge)).tolist():
                shard_out.append(s)
                body_out.append(b"P" + _asked(block, at[edge[s] : edge[s + 1]], c, codes))
        n = len(shard_out)
        return pa.table({
            "shard": pa.array(shard_out, pa.int64()), "block": pa.array([key[0].as_py()] * n, pa.int64()),
            "body": pa.array(body_out, pa.binary()),
        })

    return run


def _spread(number: int) -> int:
    """A block's number, whose low bits are all alike, as a hash."""
    return (number * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 32


def _asked(block: Block, at: np.ndarray, c: np.ndarray, codes: np.ndarray) -> bytes:
    """One block's pairs for one shard: contexts with their counts, the next
    words, once each, with their unigram codes, for each pair the number of its
    next word and its training count, and the documents it is in, with how
    often."""
    v, w, doc = block.before[at].astype(np.uint64), block.token[at].astype(np.uint64), block.doc[at].astype(np.uint64)
    words, docs = np.uint64(len(block.words)), np.uint64(len(block.ids))
    train = block.train[at]
    key = (v * words + w) * docs + doc  # under 2**63 for blocks of some million words
    post, n_post = np.unique(key, return_counts=True)
    pair, first = np.unique(post // docs, return_index=True)
    d = (post % docs).astype(np.int64)
    in_train = np.where(block.held[d], 0, n_post)
    n_train = np.add.reduceat(in_train, first)
    context, c_first = np.unique(pair // words, return_index=True)
    follow, number = np.unique((pair % words).astype(np.int64), return_inverse=True)
    context = context.astype(np.int64)
    assert train.sum() == n_train.sum()
    name = _name(block.words[follow])
    return to_blob(
        block.words[context], c[context], np.diff(np.append(c_first, len(pair))),
        name & np.uint64(0xFFFFFFFF), name >> np.uint64(32), codes[follow], number, n_train,
        np.diff(np.append(first, len(post))), d, n_post,
    )


def _answers(shard: pa.Table) -> pa.Table:
    """Step 4: the shard's trie, and each block's sums by document."""
    blocks, bodies, asked = [], [], []
    for block, body in zip(shard.column("block").to_pylist(), shard.column("body").to_pylist()):
        if body[:1] == b"B":
            blocks.append(block), bodies.append(body)
        else:
            asked.append((block, from_blob(body[1:])))
    trie = _trie([a for _, a in asked]) if asked else None
    for block, a in asked:
        _, c, _, uni = _pairs(a)
        log10p = trie.lookup(a[0].astype(np.uint64), _words(a), a[2], a[6])
        log10p = np.where(np.isnan(log10p), np.log10(MU * uni / (c + MU)), log10p)
        sums = np.bincount(a[9], weights=np.repeat(log10p, a[8]) * a[10])
        docs = np.unique(a[9])
        blocks.append(block), bodies.append(b"S" + to_blob(docs, sums[docs].astype(np.float32)))
    return pa.table({"block": pa.array(blocks, pa.int64()), "body": pa.array(bodies, pa.binary())})


def _pairs(a: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Context, its count, next word and unigram probability of each pair."""
    uni = 10.0 ** (-_UNI_STEP * a[5])
    return np.repeat(a[0], a[2]).astype(np.uint64), np.repeat(a[1], a[2]), _words(a)[a[6]], uni[a[6]]


def _words(a: list[np.ndarray]) -> np.ndarray:
    return a[3].astype(np.uint64) | a[4].astype(np.uint64) << np.uint64(32)


def _trie(asked: list[list[np.ndarray]]) -> Trie:
    """The shard's trie: its bigrams with a training count."""
    context, word, n, p = [], [], [], []
    for a in asked:
        seen = a[7] > 0
        v, c, w, uni = _pairs(a)
        context.append(v[seen]), word.append(w[seen]), n.append(a[7][seen].astype(np.int64))
        p.append(np.stack([MU * uni[seen], c[seen] + MU]).astype(np.float32))
    context, word, n, p = np.concatenate(context), np.concatenate(word), np.concatenate(n), np.concatenate(p, axis=1)
    order = np.lexsort((word, context))
    context, word = context[order], word[order]
    first = np.flatnonzero(np.r_[True, (context[1:] != context[:-1]) | (word[1:] != word[:-1])][: len(order)])
    total = np.add.reduceat(n[order], first) if len(first) else n
    p = p[:, order[first]]
    return Trie.from_buffer(Trie.build(context[first], word[first], np.log10((total + p[0]) / p[1])).to_bytes())


_RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)


def _sums(tokens: int):
    def run(answers: pa.Table) -> pa.Table:
        sums = []
        for body in answers.column("body").to_pylist():
            if body[:1] == b"B":
                unnamed, ids, held, n_tokens, n_known, base, score = from_blob(body[1:])
            else:
                sums.append(from_blob(body[1:]))
        score = score.copy()
        # In one order whatever the order of arrival, for equal reruns.
        for docs, part in sorted(sums, key=lambda s: (s[0].tobytes(), s[1].tobytes())):
            score[docs] += part
        doc_ids = pa.array(ids.astype(np.uint64).view(np.int64), mask=unnamed.astype(bool))
        return pa.table({
            "doc_id": doc_ids, "held_out": pa.array(held.astype(bool)),
            "n_tokens": n_tokens.astype(np.int64), "n_known": n_known.astype(np.int64),
            "train_tokens": np.full(len(ids), tokens, np.int64), "base_score": base, "score": score,
        })

    return run


def scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    of each row."""
    spark = docs.sparkSession
    blocks, _ = saved(word_blocks(docs, lower=True, block_words=BLOCK_WORDS, level=BLOCK_LEVEL), "lm-blocks")
    pairs = blocks.select(F.explode(F.arrays_zip("doc_ids", "lens")).alias("d")).select("d.doc_ids", "d.lens")
    held = F.coalesce(F.crc32(F.col("doc_ids").cast("string").cast("binary")) % MODULUS == HELD, F.lit(False))
    tokens = pairs.where(~held).agg(F.sum(F.col("lens") + 1)).first()[0] or 0
    words = blocks.mapInArrow(_word_counts(shards(tokens)), "part bigint, block bigint, body binary")
    # Fewer than 1 / HOT_SHARE words can have more than that share of tokens.
    counts, _ = saved(
        words.groupBy("part").applyInArrow(
            _corpus_counts(tokens * HOT_SHARE),
            "block bigint, part bigint, body binary, types bigint, hot array<bigint>, hot_n array<bigint>",
        ),
        "lm-counts",
    )
    types = counts.agg(F.sum("types")).first()[0] or 0
    known = counts.select(F.explode(F.arrays_zip("hot", "hot_n")).alias("h")).select("h.hot", "h.hot_n").collect()
    hot = np.array([r["hot"] for r in known], np.int64).view(np.uint64)
    order = np.argsort(hot)
    corpus = Corpus(tokens, types, hot[order])
    # At most a million pairs of hot words.
    found = blocks.mapInArrow(_hot_pairs(corpus.hot), "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    rows = sorted((r["pair"], r["n"]) for r in found.toLocalIterator()) if len(hot) else []
    pair, n = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    corpus.with_hot_pairs(np.array([r["hot_n"] for r in known], np.int64)[order], pair, n)
    shared = spark.sparkContext.broadcast(corpus)
    probes = blocks.groupBy("block").cogroup(counts.select("block", "part", "body").groupBy("block")).applyInArrow(
        _probes(shared), "shard bigint, block bigint, body binary"
    )
    answers = probes.groupBy("shard").applyInArrow(_answers, "block bigint, body binary")
    return answers.groupBy("block").applyInArrow(_sums(tokens), _RESULT)
