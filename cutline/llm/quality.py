"""Quality by perplexity under an interpolated modified Kneser-Ney model of characters, trained on trusted text.

The model looks at ``ORDER`` - 1 characters and knows every code point; what the trusted text never shows shares the last
back-off equally. Counts cover all trusted text: tasks count their share, the shares are summed by n-gram, and the tables of
discounts and back-off weights come from joins of the count tables, sharded by context and kept as Parquet. They grow with
the trusted text and never leave the tables: documents are packed into batches, the distinct n-grams of all batches are joined
with the tables of every order, and each batch gets back the probabilities of its own n-grams. A document is scored over its
whole text, and is rejected if its perplexity lies above what all but a few of the trusted documents of its language have.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cutline.llm.common import bucketed, by_keys, stored, text_batches

ORDER = 4
WIDE = 21  # bits of a code point
POINTS = 0x110000  # number of code points; as a character it stands before the text start
DENSE = 1 << 22  # possible values up to which distinct ones are found by counting
COUNTED = 1 << 20  # characters whose n-grams are told apart at once
BATCH = 1 << 24  # bytes of text of a batch of documents
GRAMS = 1 << 20  # distinct n-grams at which a batch ends, too
LEVEL = 3  # of compression


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _distinct(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the place of each code among them. Codes lie below ``size``; few possible ones need no sort."""
    if size > DENSE:
        return np.unique(codes, return_inverse=True)
    seen = np.flatnonzero(np.bincount(codes))
    place = np.zeros(int(seen[-1]) + 1, np.int32)
    place[seen] = np.arange(len(seen), dtype=np.int32)
    return seen, place[codes]


def _ranked(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a run of characters and, from the ``ORDER``-th character on, which of them ends there.

    The n-grams come as rows of ``ORDER`` characters, in their order. They are pairs of pairs, of which a text has few.
    """
    seen, r = _distinct(s, POINTS + 1)
    pairs, p = _distinct(r[:-1].astype(np.int64) * len(seen) + r[1:], len(seen) ** 2)
    codes, which = _distinct(p[:-2].astype(np.int64) * len(pairs) + p[2:], len(pairs) ** 2)
    both = np.stack([pairs[codes // len(pairs)], pairs[codes % len(pairs)]], 1)
    return seen[np.stack([both // len(seen), both % len(seen)], 2).reshape(-1, ORDER)], which


def _joined(grams: np.ndarray) -> np.ndarray:
    """Characters of each row as one number."""
    out = np.zeros(len(grams), np.int64)
    for i in range(grams.shape[1]):
        out = out << WIDE | grams[:, i]
    return out


def _pieces(text: str) -> Iterator[np.ndarray]:
    """The characters of a text in pieces of ``COUNTED``, each behind the ``ORDER`` - 1 characters before it."""
    before = np.full(ORDER - 1, POINTS, np.int64)
    for at in range(0, len(text), COUNTED):
        piece = np.concatenate([before, code_points(text[at : at + COUNTED])])
        yield piece
        before = piece[1 - ORDER :]


def _grouped(texts: list[str]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Numbers of texts and their pieces, about ``COUNTED`` characters at a time."""
    numbers, held, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in _pieces(text):
            numbers.append(i)
            held.append(piece)
            size += len(piece)
            if size >= COUNTED:
                yield numbers, held
                numbers, held, size = [], [], 0
    if held:
        yield numbers, held


def _ends(held: list[np.ndarray]) -> np.ndarray:
    """Which of the n-grams of all pieces in a row belong to one piece."""
    return np.concatenate([np.arange(len(p)) >= ORDER - 1 for p in held])[ORDER - 1 :]


def gram_counts(texts: DataFrame) -> DataFrame:
    """(context, point, c): occurrences of every n-gram of order ``ORDER`` in the column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, held in _grouped(batch.column(0).to_pylist()):
                grams, which = _ranked(np.concatenate(held))
                n = np.bincount(which[_ends(held)], minlength=len(grams))
                grams, n = grams[n > 0], n[n > 0]
                yield pa.RecordBatch.from_pydict({"context": pa.array(_joined(grams[:, :-1])), "point": pa.array(grams[:, -1], pa.int32()), "c": pa.array(n, pa.int64())})

    return text_batches(texts.select("text"), run, "context long, point int, c long").groupBy("context", "point").agg(F.sum("c").alias("c"))


def discounts(spectrum: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2, 3 and more, from how many n-grams have the counts 1 to 4."""
    n1, n2, n3, n4 = (spectrum.get(i, 0) for i in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.75, 0.75
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return tuple(min(max(d, 0.05), i - 0.05) for i, d in ((1, d1), (2, d2), (3, d3)))


def shares(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Per order from 1 on, stored: (context, point, own) and (context, weight). Lower orders count distinct left neighbours."""
    out, now = [], counts
    for n in range(ORDER, 0, -1):
        spectrum = {r["c"]: r["n"] for r in now.where("c <= 4").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
        d1, d2, d3 = discounts(spectrum)
        cut = now.withColumn("cut", F.when(F.col("c") == 1, F.lit(d1)).when(F.col("c") == 2, F.lit(d2)).otherwise(F.lit(d3)))
        contexts = stored(cut.groupBy("context").agg(F.sum("c").alias("total"), F.sum("cut").alias("mass")), batch_rows=5000)
        own = stored(cut.join(contexts, "context").select("context", "point", ((F.col("c") - F.col("cut")) / F.col("total")).alias("own")))
        out.append((own, contexts.select("context", (F.col("mass") / F.col("total")).alias("weight"))))
        if n > 1:
            shorter = F.col("context").bitwiseAND(F.lit((1 << WIDE * (n - 2)) - 1).cast("long"))
            now = stored(now.select(shorter.alias("context"), "point").groupBy("context", "point").agg(F.count(F.lit(1)).alias("c")))
    return out[::-1]


def looked_up(grams: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(context, point, log): the distinct n-grams ``grams`` joined with the tables of all orders, by context."""
    now = grams.withColumn("p", F.lit(0.0)).withColumn("scale", F.lit(1.0))
    for n in range(ORDER, 0, -1):
        own, contexts = tables[n - 1]
        now = now.withColumn("__c", F.col("context").bitwiseAND(F.lit((1 << WIDE * (n - 1)) - 1).cast("long")))
        now = now.join(own.select(F.col("context").alias("__c"), "point", "own"), ["__c", "point"], "left")
        now = now.join(contexts.select(F.col("context").alias("__c"), "weight"), "__c", "left")
        now = now.select("context", "point", (F.col("p") + F.col("scale") * F.coalesce("own", F.lit(0.0))).alias("p"), (F.col("scale") * F.coalesce("weight", F.lit(1.0))).alias("scale"))
    return now.select("context", "point", F.log(F.col("p") + F.col("scale") / F.lit(float(POINTS))).alias("log"))


def _united(grams: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of several lists (contexts, points), sorted."""
    contexts, points = (np.concatenate(x) for x in zip(*grams))
    order = np.lexsort((points, contexts))
    contexts, points = contexts[order], points[order]
    new = np.ones(len(order), bool)
    new[1:] = (contexts[1:] != contexts[:-1]) | (points[1:] != points[:-1])
    return contexts[new], points[new]


class _Open:
    """A batch that is being packed: columns of its documents, their texts in one compressed stream, distinct n-grams."""

    def __init__(self):
        self.columns, self.sizes, self.size = ([], [], []), [], 0
        self.stream, self.body = zstandard.ZstdCompressor(level=LEVEL).compressobj(), []
        self.grams, self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0

    def add(self, rows: pa.RecordBatch) -> None:
        for held, i in zip(self.columns, range(3)):
            held.append(rows.column(i))
        texts = rows.column(3).to_pylist()
        for text in texts:
            raw = (text or "").encode("utf-8", "surrogatepass")
            self.body.append(self.stream.compress(raw))
            self.sizes.append(-1 if text is None else len(raw))
            self.size += len(raw)
        for _, pieces in _grouped([t for t in texts if t]):
            grams, which = _ranked(np.concatenate(pieces))
            grams = grams[np.bincount(which[_ends(pieces)], minlength=len(grams)) > 0]
            self.grams.append((_joined(grams[:, :-1]), grams[:, -1]))
            self.found += len(grams)
            if self.found >= 2 * GRAMS:
                self.unite()

    def unite(self) -> None:
        self.grams = [_united(self.grams)]
        self.found = len(self.grams[0][0])

    def full(self) -> bool:
        return self.size >= BATCH or self.found >= GRAMS

    def row(self, key_type: pa.DataType) -> pa.RecordBatch:
        self.unite()
        contexts, points = self.grams[0]
        body = b"".join([*self.body, self.stream.flush()])
        lists = [pa.concat_arrays(x) for x in self.columns] + [pa.array(x, pa.int64()) for x in (self.sizes, contexts, points)]
        types = [key_type, pa.string(), *[pa.int64()] * 4]
        arrays = [pa.ListArray.from_arrays([0, len(x)], x.cast(t)) for x, t in zip(lists, types)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([body], pa.binary())], ["keys", "langs", "marks", "sizes", "contexts", "points", "body"])


def packed(texts: DataFrame, key: str) -> DataFrame:
    """Batches of documents: keys, langs, marks, sizes in bytes (-1: null), their texts compressed, and their distinct n-grams.

    They lie in buckets by ``batch``, each where its documents were read: texts are written once and never shuffled.
    """
    kind, key_type = dict(texts.dtypes)[key], to_arrow_type(texts.schema[key].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = _Open()
        for batch in batches:
            now.add(batch)
            if now.full():
                now.unite()
                if now.full():
                    yield now.row(key_type)
                    now = _Open()
        if now.sizes:
            yield now.row(key_type)

    schema = f"keys array<{kind}>, langs array<string>, marks array<long>, sizes array<long>, contexts array<long>, points array<long>, body binary"
    rows = text_batches(texts.select(key, "lang", "mark", "__text"), run, schema).withColumn("batch", F.monotonically_increasing_id())
    return bucketed(rows, ["batch"], int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), move=False)


def _places(contexts: np.ndarray, points: np.ndarray, of: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the n-grams (``of``, ``at``) stand among the sorted distinct ones; the number of those if they are not there."""
    if not len(contexts):
        return np.zeros(len(of), np.int64)
    heads = contexts[np.flatnonzero(np.diff(contexts, prepend=contexts[0] - 1))]
    known = np.searchsorted(heads, contexts) << WIDE | points
    head = np.minimum(np.searchsorted(heads, of), len(heads) - 1)
    wanted = head << WIDE | at
    place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where((heads[head] == of) & (known[place] == wanted), place, len(known))


def scored(texts: DataFrame, tables: list[tuple[DataFrame, DataFrame]], key: str) -> DataFrame:
    """key, lang, mark, n_chars, perplexity of all documents by the count tables."""
    kind = dict(texts.dtypes)[key]
    batches = packed(texts, key)
    grams = batches.select("batch", F.posexplode(F.arrays_zip("contexts", "points")).alias("at", "gram"))
    grams = grams.select("batch", "at", F.col("gram.contexts").alias("context"), F.col("gram.points").cast("int").alias("point"))
    logs = stored(looked_up(grams.select("context", "point").distinct(), tables))
    back = grams.join(logs, ["context", "point"]).groupBy("batch").agg(F.collect_list(F.struct("at", "log")).alias("logs"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for i in range(batch.num_rows):
                row = {name: column[i] for name, column in zip(batch.schema.names, batch.columns)}
                sizes, contexts, points = (row[c].values.to_numpy() for c in ("sizes", "contexts", "points"))
                log = np.zeros(len(contexts) + 1)  # the last one: n-grams across two texts, which are not there
                if row["logs"].is_valid:
                    at, value = row["logs"].values.flatten()
                    log[at.to_numpy()] = value.to_numpy()
                stream = zstandard.ZstdDecompressor().stream_reader(row["body"].as_buffer())
                total, chars = np.zeros(len(sizes)), np.zeros(len(sizes), np.int64)

                def add(first: int, held_texts: list[str]) -> None:
                    chars[first : first + len(held_texts)] = [len(t) for t in held_texts]
                    for numbers, held in _grouped(held_texts):
                        found, which = _ranked(np.concatenate(held))
                        inside = _ends(held)
                        own = log[_places(contexts, points, _joined(found[:, :-1]), found[:, -1])]
                        text = np.repeat(numbers, [len(p) for p in held])[ORDER - 1 :]
                        total[first : first + len(held_texts)] += np.bincount(text[inside], own[which[inside]], len(held_texts))

                first, held, size = 0, [], 0
                for j, n in enumerate(sizes.tolist()):
                    held.append(stream.read(n).decode("utf-8", "surrogatepass") if n > 0 else "")
                    size += max(n, 0)
                    if size >= COUNTED:
                        add(first, held)
                        first, held, size = j + 1, [], 0
                if held:
                    add(first, held)
                loss = [math.exp(-x / n) if n > 0 else None for x, n in zip(total.tolist(), chars.tolist())]
                schema = pa.schema([(key, rows_type), ("lang", pa.string()), ("mark", pa.int64()), ("n_chars", pa.int64()), ("perplexity", pa.float64())])
                yield pa.RecordBatch.from_arrays([row["keys"].values.cast(rows_type), row["langs"].values.cast(pa.string()), row["marks"].values, pa.array(chars), pa.array(loss, pa.float64())], schema=schema)

    rows_type = to_arrow_type(texts.schema[key].dataType)
    joined = batches.join(back, "batch", "left").select("keys", "langs", "marks", "sizes", "contexts", "points", "body", "logs")
    return text_batches(joined, run, f"`{key}` {kind}, lang string, mark long, n_chars long, perplexity double")


def trusted_keys(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keys whose labels all say good quality and none says toxic."""
    worst = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    return worst.where("q = 1 and t = 0").select(key)


def perplexities(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Stored table: key, lang, mark (a hash of text and lang), n_chars, perplexity (null for a text without characters), trusted."""
    keys = stored(trusted_keys(labels, key).withColumn("__trusted", F.lit(True)))
    texts = docs.where(F.length("text") > 0)
    trusted = by_keys(texts, keys.select(key), key, "left_semi").select("text")
    tables = shares(stored(gram_counts(trusted)))
    narrow = docs.select(key, F.col("lang").cast("string").alias("lang"), _mark(docs).alias("mark"), F.col("text").alias("__text"))
    rows = stored(scored(narrow, tables, key))
    return stored(by_keys(rows, keys, key, "left").withColumn("trusted", F.coalesce("__trusted", F.lit(False))).drop("__trusted"))


def _mark(docs: DataFrame):
    return F.xxhash64(F.col("lang").cast("string"), "text")


def _verdicts(docs: DataFrame, labels: DataFrame, key: str, share: float, margin: float) -> DataFrame:
    scores = perplexities(docs, labels, key)
    known = scores.where("trusted and perplexity is not null")
    at = F.percentile_approx("perplexity", F.lit(share), F.lit(100_000))
    by_lang = stored(known.where("lang is not null").groupBy("lang").agg(at.alias("__own")))
    overall = known.agg(at.alias("t")).first()["t"]
    threshold = F.coalesce("__own", F.lit(overall).cast("double")) * F.lit(margin)
    out = scores.join(by_lang, "lang", "left").withColumn("threshold", threshold)
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return out.withColumn("kept", kept)


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", share: float = 0.98, margin: float = 1.15) -> DataFrame:
    """One row per document: key, lang, n_chars, perplexity, threshold, kept.

    The threshold of a language is ``margin`` times the perplexity that the ``share`` of its trusted documents stay below;
    languages without trusted documents (and a null lang) take the one over all trusted documents. Without any trusted
    document nothing is rejected. Null and empty texts have no perplexity and are rejected. Rows may repeat; labels that
    contradict each other make a document untrusted. Other columns are not read. An empty table gives no rows.
    """
    return _verdicts(docs, labels, key, share, margin).select(key, "lang", "n_chars", "perplexity", "threshold", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", share: float = 0.98, margin: float = 1.15) -> DataFrame:
    """The documents that ``judge`` does not reject, with their columns.

    Each row has its own verdict, by key, text and lang, so of documents that share a key, or have none, only the bad ones go.
    """
    gone = _verdicts(docs, labels, key, share, margin).where("not kept").select(F.col(key).alias("__gone"), "mark").distinct()
    gone = stored(gone.withColumnRenamed("mark", "__of"))
    return by_keys(docs.withColumn("__mark", _mark(docs)), gone, F.col(key).eqNullSafe(F.col("__gone")) & (F.col("__mark") == F.col("__of")), "left_anti").drop("__mark")
