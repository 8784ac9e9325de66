"""Canonical exact document fingerprints, with DataFrame functions only.

A text is normalised (NFKC), its case and white space folded; a 128-bit hash made of two xxhash64 values
puts equal canonical texts into one bucket. Within buckets of several rows the canonical bytes are
compared, and where they differ a number after the hash tells the texts apart, so fingerprints
are equal exactly if canonical texts are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import cut_lineage, id_and_text

#: Keys up to this many (8 bytes each) are broadcast, more are joined by a shuffle.
BROADCAST_KEYS = 4_000_000
_LEAST = -(2**63)


def canonical(text: Column) -> Column:
    """NFKC, full case folding (`ß` as `ss`, final sigma as sigma), NFKC again, runs of white space as one space, none at
    the ends; empty for null."""
    compose = lambda c: F.call_function("java_method", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))
    folded = F.call_function("java_method", F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), compose(F.coalesce(text, F.lit(""))), F.lit(True))
    return F.trim(F.regexp_replace(compose(folded), r"(?U)\s+", " "))


def wide_hash(canon: Column) -> tuple[Column, Column]:
    """128 bits: xxhash64 of the text and of the text after another value."""
    return F.xxhash64(canon), F.xxhash64(F.lit(0x9E3779B9), canon)


def _hex(a: Column, b: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def confirm(hashed: DataFrame, texts_of: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """Byte comparison inside buckets: None if no bucket holds different texts.

    hashed has row_key, h1, h2. texts_of(keys) gives h1, h2 and canon for the rows with these keys.
    Otherwise a row per text of such a bucket comes back: h1, h2, canon, number (0 for the least text).
    The least and greatest text of a bucket are found with map-side aggregation, so a hot
    bucket sends at most one row from each task.
    """
    several = hashed.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    keys = hashed.join(several, ["h1", "h2"], "left_semi").select("row_key").distinct()
    texts = texts_of(keys)
    unlike = texts.groupBy("h1", "h2").agg(F.min("canon").alias("least"), F.max("canon").alias("most")).where("least != most").select("h1", "h2")
    unlike = cut_lineage(unlike)
    if unlike.isEmpty():
        return None
    apart = texts.join(unlike, ["h1", "h2"], "left_semi").select("h1", "h2", "canon").distinct()
    return cut_lineage(apart.withColumn("number", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("canon")) - 1))


def keep_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of df whose row_key is in keys; broadcast only up to a checked number."""
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return df.join(F.broadcast(keys) if few else keys, "row_key", "left_semi")


def fingerprint(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hash_of=wide_hash) -> DataFrame:
    """Returns doc_id, fingerprint and group_size for every row.

    Null text counts as empty; rows without id and repeated rows are fingerprinted like others, and
    very long texts whole. An empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), canonical(F.col("text")).alias("canon"))
    h1, h2 = hash_of(F.col("canon"))
    rows = rows.select("*", h1.alias("h1"), h2.alias("h2"))
    hashed = cut_lineage(rows.drop("canon"))
    apart = confirm(hashed, lambda keys: keep_keys(rows, keys).select("h1", "h2", "canon"))
    if apart is None:
        marked = hashed.select("doc_id", _hex(F.col("h1"), F.col("h2")).alias("fingerprint"))
    else:
        marked = rows.join(apart, ["h1", "h2", "canon"], "left").select("doc_id", _marked("h1", "h2", F.col("number")).alias("fingerprint"))
    sizes = marked.groupBy("fingerprint").agg(F.count("*").alias("group_size"))
    return marked.join(sizes, "fingerprint").select("doc_id", "fingerprint", "group_size")


def _marked(h1: str, h2: str, number: Column) -> Column:
    return F.concat(_hex(F.col(h1), F.col(h2)), F.when(number > 0, F.concat(F.lit("-"), number.cast("string"))).otherwise(""))


def bucket_starts(rows: DataFrame, n_buckets: int) -> list[tuple[int, int]]:
    """(at, row_key) of the first row of each bucket but the first, when rows by descending (at, row_key) are cut into buckets of
    equally many. Only the two numbers are sorted, and a row for each bucket reaches the driver."""
    order = [F.desc("at"), F.desc("row_key")]
    line = rows.select("at", "row_key").repartitionByRange(n_buckets, *order).sortWithinPartitions(*order)
    line = cut_lineage(line.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")))
    sizes = {r.part: (r.first, r.n) for r in line.groupBy("part").agg(F.min("row").alias("first"), F.count("*").alias("n")).collect()}
    total = sum(n for _, n in sizes.values())
    each = max(1, -(-total // n_buckets))
    before, wanted = 0, []
    for part in sorted(sizes):
        first, n = sizes[part]
        wanted += [first + k - before for k in range(-(-before // each) * each, before + n, each) if k]
        before += n
    found = line.where(F.col("row").isin(wanted)).select("at", "row_key").collect() if wanted else []
    return sorted({(r.at, r.row_key) for r in found}, reverse=True)


def bucket_of(starts: list[tuple[int, int]]) -> Column:
    """Number of starts at or before the row, by two short scans instead of one long one."""
    if not starts:
        return F.lit(0)
    step = max(1, round(len(starts) ** 0.5))
    pairs = lambda some: F.array(*[F.struct(F.lit(a).cast("long").alias("at"), F.lit(k).cast("long").alias("row_key")) for a, k in some])
    row = F.struct("at", "row_key")
    reached = lambda c: F.size(F.filter(c, lambda x: x >= row))
    blocks = [starts[k : k + step] for k in range(0, len(starts), step)]
    some = F.array(*map(pairs, blocks))
    passed = reached(pairs([b[0] for b in blocks]))
    return F.when(passed == 0, 0).otherwise((passed - 1) * step + reached(F.element_at(some, F.greatest(passed, F.lit(1)))))


def with_next(rows: DataFrame, n_buckets: int) -> DataFrame:
    """Adds next_text and next_key of the next row by descending (doc_id, row_key), null ids last; the first follows the last.

    Rows are dealt into buckets of neighbours with equally many rows each, however ids are spread; only rows equal in id
    and text stay together. The first row of a bucket also goes, as a guest, to the bucket before it, so that each
    bucket finds its rows' successors alone.
    """
    rows = rows.withColumn("at", F.coalesce("doc_id", F.lit(_LEAST)))
    starts = bucket_starts(rows, n_buckets)
    top = rows.agg(F.max(F.struct("at", "row_key")).alias("top")).first().top
    if top is None:
        return rows.select("*", F.lit(None).cast("string").alias("next_text"), F.lit(None).cast("long").alias("next_key")).drop("at")
    starts = [x for x in starts if x != (top.at, top.row_key)]
    heads = F.array(*[F.struct(F.lit(a).cast("long").alias("at"), F.lit(k).cast("long").alias("row_key")) for a, k in [(top.at, top.row_key), *starts]])
    dealt = rows.withColumn("own", bucket_of(starts)).withColumn("head", F.element_at(heads, F.col("own") + 1) == F.struct("at", "row_key"))
    guest = F.pmod(F.col("own") - 1, F.lit(len(starts) + 1))
    own = F.struct(F.col("own").alias("b"), F.lit(False).alias("guest"))
    dealt = dealt.withColumn("bucket", F.explode(F.when(F.col("head"), F.array(own, F.struct(guest.alias("b"), F.lit(True).alias("guest")))).otherwise(F.array(own))))
    dealt = dealt.select("doc_id", "row_key", "text", "at", F.col("bucket.b").alias("b"), F.col("bucket.guest").alias("guest"))
    order = Window.partitionBy("b").orderBy("guest", F.desc("at"), F.desc("row_key"))
    return dealt.select("*", F.lead("text").over(order).alias("next_text"), F.lead("row_key").over(order).alias("next_key")).where("not guest").drop("guest", "b", "at")


def edited_rows(rows: DataFrame, n_buckets: int) -> DataFrame:
    """Rows with edited text: the last third of a text's characters replaced by as many first ones of the next row."""
    k = F.floor(F.col("n_chars") / 3).cast("int")
    n = F.char_length("text").cast("long")
    joined = with_next(rows, n_buckets).withColumn("n_chars", n)
    return joined.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - k).cast("int")), F.substring(F.col("next_text"), F.lit(1), k)))


def query(spark, sf_dir: str, hash_of=wide_hash) -> DataFrame:
    """op7: fingerprints of all documents and of their edited texts.

    The fingerprint is an exact digest, so likeness is 1 for equal fingerprints and 0 for all others, however alike the texts.
    Null text counts as empty. Rows by descending doc_id, null ids last, rows of one id by their key; a single
    row follows itself. Repeated rows each give a row. An empty table gives no rows.
    """
    from .tables import table

    rows = id_and_text(table(spark, sf_dir, "documents")).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions() * 4)

    def hashes(df: DataFrame, *keep: str) -> DataFrame:
        df = df.select(*keep, canonical(F.col("text")).alias("c"), canonical(F.col("edited")).alias("ec"))
        (h1, h2), (e1, e2) = hash_of(F.col("c")), hash_of(F.col("ec"))
        return df.select(*keep, "c", "ec", h1.alias("h1"), h2.alias("h2"), e1.alias("e1"), e2.alias("e2"))

    edited = edited_rows(rows, n_buckets).withColumn("edited_sha256", F.sha2("edited", 256))
    narrow = cut_lineage(hashes(edited, "doc_id", "row_key", "next_key", "n_chars", "edited_sha256").drop("c", "ec"))
    both = narrow.select("row_key", F.col("h1"), F.col("h2")).unionByName(narrow.select("row_key", F.col("e1").alias("h1"), F.col("e2").alias("h2")))
    pairs = narrow.select("row_key", "next_key")

    def texts_of(keys: DataFrame) -> DataFrame:
        """Canonical texts, original and edited, of the rows with these keys: only they and their successors are read out."""
        mine = cut_lineage(keep_keys(pairs, keys).distinct())
        wanted = mine.select(F.explode(F.array("row_key", "next_key")).alias("row_key")).distinct()
        some = keep_keys(rows, wanted).select("row_key", "text")
        after = some.select(F.col("row_key").alias("next_key"), F.col("text").alias("next_text")).dropDuplicates(["next_key"])
        n = F.char_length("text")
        k = F.floor(n / 3).cast("int")
        made = mine.join(some, "row_key").join(after, "next_key").withColumn("edited", F.concat(F.substring("text", F.lit(1), n - k), F.substring(F.col("next_text"), F.lit(1), k)))
        h = hashes(made, "row_key")
        return h.select("h1", "h2", F.col("c").alias("canon")).unionByName(h.select(F.col("e1").alias("h1"), F.col("e2").alias("h2"), F.col("ec").alias("canon")))

    apart = confirm(both, texts_of)
    if apart is None:
        out = narrow.select("*", _hex(F.col("h1"), F.col("h2")).alias("fingerprint"), _hex(F.col("e1"), F.col("e2")).alias("edited_fingerprint"))
        after = narrow.select(F.col("row_key").alias("next_key"), F.col("h1").alias("n1"), F.col("h2").alias("n2")).dropDuplicates(["next_key"])
        out = out.join(after, "next_key", "left").withColumn("next_fingerprint", _hex(F.col("n1"), F.col("n2")))
    else:
        full = hashes(edited, "doc_id", "row_key", "next_key", "n_chars", "edited_sha256")
        own = apart.select("h1", "h2", F.col("canon").alias("c"), F.col("number").alias("a"))
        other = apart.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("canon").alias("ec"), F.col("number").alias("b"))
        out = full.join(own, ["h1", "h2", "c"], "left").join(other, ["e1", "e2", "ec"], "left").drop("c", "ec")
        out = cut_lineage(out.select("*", _marked("h1", "h2", F.col("a")).alias("fingerprint"), _marked("e1", "e2", F.col("b")).alias("edited_fingerprint")))
        after = out.select(F.col("row_key").alias("next_key"), F.col("fingerprint").alias("next_fingerprint")).dropDuplicates(["next_key"])
        out = out.join(after, "next_key", "left")
    alike = lambda c: (F.col("fingerprint") == F.col(c)).cast("double")
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", alike("edited_fingerprint").alias("near_edited"), alike("next_fingerprint").alias("near_next"))
