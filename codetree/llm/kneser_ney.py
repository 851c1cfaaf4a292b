"""Quality classifier: an interpolated modified Kneser-Ney model of characters, trained on trusted text.

Spark counts all runs of ``ORDER`` characters of the trusted texts, as they are, by shards of the run, derives the
continuation counts of shorter runs, and joins each count with the totals of its context. The tables of
shares grow with the runs the texts hold and never leave Spark. To score, texts are put together in
packages; the distinct runs of all packages are joined with the shares of every length, and each package gets
the shares of its own runs back.

Below single characters the model rests on a class model of the same kind instead of all characters being
equally likely: characters are folded to ``SYMBOLS`` classes (a border, white space, letters without case, digits, some
marks, and a few for letters beyond a-z), and those of a class share its probability. That
table has ``SYMBOLS ** ORDER`` entries whatever the corpus, 10 MB, and is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codetree.llm.tables import filter_bits, may_hold
from codetree.llm.words import slices
from codetree.staging import stage

SYMBOLS = 40
ORDER = 4
# Quantile of trusted texts' perplexity, per language, above which a text is rejected.
QUANTILE = 0.99
MARGIN = 1.05
# Bits of a character in the number of a context; 0 is the border, so characters count from 1.
BITS = 21
# Texts are scored in packages of about this many bytes, cut in slices.
PACKAGE_BYTES = 1 << 24


@cache
def _symbol_table() -> np.ndarray:
    """Symbol of every code point: 1 space, 2-27 letters, 28 digits, 29-33 marks, 34-39 other letters."""
    table = np.full(0x110000, 33, np.uint8)
    points = np.arange(0x110000)
    table[0x80:] = 34 + points[0x80:] % 6
    table[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0]] = 1
    for i in range(26):
        table[[ord("a") + i, ord("A") + i]] = 2 + i
    table[ord("0") : ord("9") + 1] = 28
    for mark, symbol in ((".", 29), (",", 30), ("!", 31), ("?", 32)):
        table[ord(mark)] = symbol
    return table


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, with a place for a border after each, and where each text begins (and the last ends)."""
    points = np.frombuffer("".join([t + "\0" for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.cumsum([0, *[len(t) + 1 for t in texts]], dtype=np.int64)


def _windows(symbols: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """The ``ORDER`` symbols of the run that ends in each symbol; borders (0) stand before each text and as its last symbol."""
    pad, n = ORDER - 1, len(first) - 1
    held = np.zeros(len(symbols) + pad * n, symbols.dtype)
    held[np.arange(len(symbols)) + np.repeat(np.arange(1, n + 1), np.diff(first)) * pad] = symbols
    inside = np.ones(len(held), bool)  # runs that start in the last places of a text go over its end
    for k in range(pad):
        inside[first[1:] + pad * np.arange(1, n + 1) - 1 - k] = False
    begin = np.flatnonzero(inside)
    return [held[begin + k] for k in range(ORDER)]


def _folded(symbols: list[np.ndarray]) -> np.ndarray:
    number = np.zeros(len(symbols[0]), np.int32)
    for each in symbols:
        number = number * np.int32(SYMBOLS) + each
    return number


def runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all runs of ``ORDER`` classes, one per character, and where each text's begin (and the last's end).

    Borders stand before each text and, as its last symbol, after it; an empty text has the one run that ends in the border.
    """
    points, first = _points(texts)
    symbols = _symbol_table()[points]
    symbols[first[1:] - 1] = 0
    return _folded(_windows(symbols, first)), first


def plain_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``runs``, but of the characters themselves: the number of each run's first characters, its last one, and ``first``."""
    points, first = _points(texts)
    symbols = points.astype(np.int64) + 1
    symbols[first[1:] - 1] = 0
    *before, last = _windows(symbols, first)
    return reduce(lambda number, x: (number << BITS) | x, before), last, first


def _distinct(context: np.ndarray, symbol: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs in order, and how often each occurs."""
    contexts, place = np.unique(context, return_inverse=True)
    keys, at = np.unique((place << BITS) | symbol, return_inverse=True)
    return contexts[keys >> BITS], keys & ((1 << BITS) - 1), np.bincount(at, n, len(keys)).astype(np.int64)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high in slices(batch.column(0)):
            context, symbol, _ = plain_runs([t or "" for t in batch.column(0).slice(low, high - low).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _distinct(context, symbol)], ["context", "symbol", "n"])


def _counts(trusted: DataFrame, text: str) -> DataFrame:
    """``(context, symbol, n)``: how often the trusted texts hold each run of ``ORDER`` characters."""
    rows = trusted.select(F.col(text).alias("text")).filter("text is not null")
    counted = rows.mapInArrow(_count, "context long, symbol long, n long")
    return stage(counted.groupBy("context", "symbol").agg(F.sum("n").alias("n")), "runs")


def _classes(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The number of each run's run of classes."""
    places = [(context >> (BITS * k)) & ((1 << BITS) - 1) for k in reversed(range(ORDER - 1))] + [symbol]
    table = np.concatenate([np.zeros(1, np.uint8), _symbol_table()])
    return _folded([table[p] for p in places])


def _class_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**ORDER, np.int64)
    for batch in batches:
        context, symbol, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        np.add.at(total, _classes(context, symbol), n)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["run", "n"])


def _discounts(counts: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney, from how many runs were seen one to four times."""
    row = counts.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (float(x or 0) for x in row)
    if not (n1 and n2):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1)]


def _discount(n: Column, discounts: list[float]) -> Column:
    return F.when(n == 1, discounts[0]).when(n == 2, discounts[1]).otherwise(discounts[2])


def train(trusted: DataFrame, text: str = "text") -> np.ndarray:
    """Log-probability of the last class of every run of classes given those before, from all trusted texts.

    Without any trusted text all classes are equally likely. The driver gets the seen runs of every length with their
    discounted shares, ``SYMBOLS ** ORDER`` at most.
    """
    return _class_model(_counts(trusted, text))


def _class_model(plain: DataFrame) -> np.ndarray:
    counts = stage(plain.mapInArrow(_class_counts, "run long, n long").groupBy("run").agg(F.sum("n").alias("n")), "class-runs")
    shares: dict[int, tuple] = {}
    for length in range(ORDER, 0, -1):
        seen = _shares(counts.select(F.expr(f"run div {SYMBOLS}").alias("context"), F.col("run").alias("symbol"), "n"))
        shares[length] = seen.toArrow().to_pandas()
        if length > 1:  # in how many contexts a shorter run was seen
            counts = stage(counts.groupBy((F.col("run") % SYMBOLS ** (length - 1)).alias("run")).agg(F.count(F.lit(1)).alias("n")), "class-runs")
    known = np.full(1, 1 / SYMBOLS)
    for length in range(1, ORDER + 1):
        own = shares[length]
        rest = np.ones(SYMBOLS ** (length - 1))
        rest[own["context"].to_numpy(int)] = own["rest"].to_numpy()
        lower = known if length > 1 else np.full(SYMBOLS, 1 / SYMBOLS)
        probability = np.tile(lower, SYMBOLS) if length > 1 else lower.copy()
        probability *= np.repeat(rest, SYMBOLS)
        probability[own["symbol"].to_numpy(int)] += own["share"].to_numpy()
        known = probability
    return np.log(np.maximum(known, 1e-12)).astype(np.float32)


def _shares(counts: DataFrame) -> DataFrame:
    """``(context, symbol, share, rest)``: the discounted share of each run in its context, and what the context leaves to shorter ones."""
    discounts = _discounts(counts)
    lost = _discount(F.col("n"), discounts)
    totals = counts.groupBy("context").agg(F.sum("n").alias("total"), F.sum(lost).alias("lost"))
    joined = counts.join(totals, "context")
    return joined.select("context", "symbol", ((F.col("n") - lost) / F.col("total")).alias("share"), (F.col("lost") / F.col("total")).alias("rest"))


def _shorter(length: int) -> Column:
    """The context of the run of ``length`` characters that a longer one ends in."""
    return F.col("context").bitwiseAND(F.lit((1 << BITS * (length - 1)) - 1).cast("long"))


def _scored(found: DataFrame, counts: DataFrame) -> DataFrame:
    """``(context, symbol, share, rest)`` of the runs ``found``: with lengths put together, and what is left to the class model.

    Runs meet the shares of all lengths by joins, longest first; neither side has a bound.
    """
    rows = found.withColumns({"share": F.lit(0.0), "rest": F.lit(1.0)})
    for length in range(ORDER, 0, -1):
        shares = stage(_shares(counts), "shares")
        own = shares.select(F.col("context").alias("_context"), F.col("symbol").alias("_symbol"), F.col("share").alias("_share"))
        rests = stage(shares.groupBy(F.col("context").alias("_context")).agg(F.max("rest").alias("_rest")), "rests")
        short = _shorter(length)
        rows = rows.join(own, (short == own["_context"]) & (F.col("symbol") == own["_symbol"]), "left").drop("_context", "_symbol")
        rows = rows.join(rests, short == rests["_context"], "left").select(
            "context",
            "symbol",
            (F.col("share") + F.col("rest") * F.coalesce("_share", F.lit(0.0))).alias("share"),
            (F.col("rest") * F.coalesce("_rest", F.lit(1.0))).alias("rest"),
        )
        if length > 1:
            counts = stage(counts.groupBy(_shorter(length - 1).alias("context"), "symbol").agg(F.count(F.lit(1)).alias("n")), "runs")
    return rows


def _packages(rows: DataFrame) -> DataFrame:
    """``(package, texts, contexts, symbols)``: rows (id, lang, text) as compressed slices, and the distinct runs of each package."""

    def pack(held: list[bytes], found: list[tuple]) -> pa.RecordBatch:
        context, symbol, _ = _distinct(*map(np.concatenate, zip(*found)))
        kinds = [pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((held, context, symbol.astype(np.int32)), kinds)], ["texts", "contexts", "symbols"])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found, size = [], [], 0
        for batch in batches:
            for low, high in slices(batch.column(2)):
                part = batch.slice(low, high - low)
                context, symbol, _ = plain_runs([t or "" for t in part.column(2).to_pylist()])
                found.append(_distinct(context, symbol)[:2])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(part)
                held.append(sink.getvalue().to_pybytes())
                size += len(context)
                if size >= PACKAGE_BYTES:
                    yield pack(held, found)
                    held, found, size = [], [], 0
        if held:
            yield pack(held, found)

    made = rows.mapInArrow(work, "texts array<binary>, contexts array<long>, symbols array<int>")
    return stage(made.withColumn("package", F.monotonically_increasing_id()), "packages")


def perplexity(df: DataFrame, counts: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``(id_column, lang, perplexity)`` per row: per character of the whole text and its end. A null text has none.

    ``counts`` are those of the trusted texts.
    """
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    packages = _packages(rows)
    each = packages.select(F.col("package").alias("owner"), F.posexplode(F.arrays_zip("contexts", "symbols")).alias("place", "run"))
    each = each.select("owner", "place", F.col("run.contexts").alias("context"), F.col("run.symbols").cast("long").alias("symbol"))
    base = np.exp(_class_model(counts).astype(np.float64))
    sizes = np.maximum(np.bincount(_symbol_table(), minlength=SYMBOLS), 1)
    held = df.sparkSession.sparkContext.broadcast((base.reshape(-1, SYMBOLS) / sizes).ravel().astype(np.float32))

    def value(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, symbol, share, rest = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            found = np.log(np.maximum(share + rest * held.value[_classes(context, symbol)], 1e-300)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], ["context", "symbol", "value"])

    def work(own: pa.Table, scored: pa.Table) -> pa.Table:
        context, symbol = (own.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("contexts", "symbols"))
        value = np.empty(len(context), np.float64)
        value[scored.column("place").to_numpy()] = scored.column("value").to_numpy()
        contexts, place = np.unique(context, return_inverse=True)
        keys = (place << BITS) | symbol  # the package's runs are in order
        out = []
        for texts in (t for row in own.column("texts").to_pylist() for t in row):
            batch = pa.ipc.open_stream(texts).read_next_batch()
            here, last, first = plain_runs([t or "" for t in batch.column(2).to_pylist()])
            at = np.searchsorted(keys, (np.searchsorted(contexts, here) << BITS) | last)
            sums = np.add.reduceat(value[at], first[:-1])
            empty = batch.column(2).is_null().to_numpy(zero_copy_only=False)
            values = pa.array(np.exp(-sums / np.diff(first)), mask=empty)
            out.append(pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.string()), values], names))
        return pa.Table.from_batches(out, pa.schema([(names[0], pa.int64()), ("lang", pa.string()), ("perplexity", pa.float64())]))

    names = [id_column, "lang", "perplexity"]
    known = _scored(each.select("context", "symbol").distinct(), counts).mapInArrow(value, "context long, symbol long, value float")
    scored = each.join(stage(known, "scored-runs"), ["context", "symbol"]).select("owner", "place", "value")
    both = packages.groupBy("package").cogroup(scored.groupBy("owner"))
    return both.applyInArrow(work, f"`{id_column}` long, lang string, perplexity double")


def _trusted(df: DataFrame, good: DataFrame, id_column: str, text: str) -> DataFrame:
    """``(text)`` of the rows whose id is in ``good``.

    A filter of 8 MB drops most other texts where they are read; the join, which moves texts, settles the rest. It is a
    merge join at every size, as neither side has a bound.
    """
    held = df.sparkSession.sparkContext.broadcast(filter_bits(good, "good_id"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(may_hold(held.value, batch.column(0).to_numpy())))

    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text")).filter("id is not null and text is not null")
    likely = rows.mapInArrow(work, "id long, text string")
    return likely.join(good.hint("merge"), likely["id"] == good["good_id"], "left_semi").select("text")


def classify(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """``(id_column, lang, perplexity, threshold, keep)`` for every row of ``df``.

    The model is trained on texts that ``labels`` (doc_id, quality) call good (1). A language's threshold is the
    ``quantile`` of its trusted texts' perplexity times ``margin``; a language without trusted texts (a null one is a language of
    its own) takes the quantile over all its texts. Texts above it, and
    null ones, are not kept. Repeated rows come out repeatedly.
    """
    good = stage(labels.filter("quality = 1").select(F.col("doc_id").cast("long").alias("good_id")).filter("good_id is not null").distinct(), "good")
    scored = stage(perplexity(df, _counts(_trusted(df, good, id_column, text), "text"), id_column, text), "perplexity")
    marked = scored.join(good, scored[id_column] == good["good_id"], "left").withColumn("group", F.coalesce("lang", F.lit("")))
    value = F.col("perplexity")
    limits = marked.groupBy("group", F.col("lang").isNull().alias("no_lang")).agg(
        (F.coalesce(F.percentile_approx(F.when(F.col("good_id").isNotNull(), value), quantile, 10_000), F.percentile_approx(value, quantile, 10_000)) * margin).alias("threshold")
    )
    limits = limits.withColumnRenamed("group", "own_group").withColumnRenamed("no_lang", "own_null")
    here = scored.withColumn("group", F.coalesce("lang", F.lit("")))
    joined = here.join(limits, (here["group"] == limits["own_group"]) & (here["lang"].isNull() == limits["own_null"]), "left")
    return joined.select(id_column, "lang", "perplexity", "threshold", F.coalesce(value <= F.col("threshold"), F.lit(False)).alias("keep"))
