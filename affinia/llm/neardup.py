"""Near-duplicate documents from bottom-k sketches of one hash function.

Documents are sets of word shingles. A sketch holds the least hash values of
a set, all drawn with one function, so the sketches of two documents also
give the least values of their union. The steps:

1. Documents with the same set form a class; only one member goes on.
2. Inverted lists of the retained values. A document that shares too few of its
   values with anyone cannot have a partner and is dropped.
3. Each list is linked to its most typical member; overlaps are counted,
   the union sketch rules out unlikely pairs, full sets confirm the rest.
4. What these links leave in different components of one list is
   compared pair by pair in the same way. Lists longer than ``LONG_LIST`` are
   left out here. Only documents made mostly of such values need them, all
   others meet their partners in a short list. Those documents meet
   under the rarest shingles of their full sets instead: prefix and position
   filters are exact, and leave few pairs of a large group of loose copies.

What sketches must show follows from the similarity asked for: a pair that just has
it fails one of these tests with a probability below one in a million. No
partner or candidate is capped.

Defined results: a null or empty text has no shingles and no links; repeated
rows are links of one component; rows that share a doc_id but not the text
are compared as documents of their own; a row without doc_id is never linked,
its component is null and it is kept. Other columns are not read.
"""

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.llm.arrays import distinct_sorted, list_column, shingle_hashes, slices
from affinia.llm.columns import unused
from affinia.llm.components import components
from affinia.sources.workspace import temporary, written

SHINGLE_WORDS = 5
SIMILARITY = Fraction(85, 100)
SKETCH = 48  # values of a sketch
LISTED = 24  # of them, those with an inverted list
LONG_LIST = 50  # documents; see step 4
RISK = 2.5e-7  # of each of four tests: that the values of a pair that is similar fail it

_SKETCH_SCHEMA = "doc_id long, text_id long, n_shingles long, class string, sketch array<long>"


def _least_common(values: int, similarity: Fraction) -> int:
    """How many of so many values two sets of this similarity have in common, but for ``RISK``.

    Each is common with this probability at least, and draws without replacement vary less than these.
    """
    s, below = float(similarity), 0.0
    for n in range(values):
        below += comb(values, n) * s**n * (1 - s) ** (values - n)
        if below > RISK:
            return n
    return values


def _digest(values: np.ndarray) -> str | None:
    """Name of a set, from its distinct values in ascending order."""
    if not len(values):
        return None
    return hashlib.blake2b(values.tobytes(), digest_size=16).hexdigest()


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in slices(batches):
        hashes, before = shingle_hashes(data, offsets, SHINGLE_WORDS)
        sizes, classes, kept = [], [], []
        for begin, end in zip(before[:-1], before[1:]):
            values = distinct_sorted(hashes[begin:end])
            sizes.append(len(values))
            classes.append(_digest(values))
            kept.append(values[:SKETCH].astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                part.column("text_id"),
                pa.array(sizes, pa.int64()),
                pa.array(classes, pa.string()),
                list_column(kept, pa.int64()),
            ],
            names=["doc_id", "text_id", "n_shingles", "class", "sketch"],
        )


def sketches(docs: DataFrame) -> DataFrame:
    """Set size, set digest (null for an empty set) and bottom-k sketch of each document."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_id")
    )
    return rows.mapInArrow(_sketches, _SKETCH_SCHEMA)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in slices(batches):
        hashes, before = shingle_hashes(data, offsets, SHINGLE_WORDS)
        ids, sets = [], []
        rows = zip(part.column("rep").to_pylist(), part.column("class").to_pylist())
        for (rep, wanted), begin, end in zip(rows, before[:-1], before[1:]):
            values = distinct_sorted(hashes[begin:end])
            if _digest(values) == wanted:  # another text under the same doc_id is not meant
                ids.append(rep)
                sets.append(values.astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), list_column(sets, pa.int64())], names=["rep", "shingles"]
        )


def _alike(left: str, right: str, similarity: Fraction) -> F.Column:
    """Whether the sizes of two sets allow the similarity."""
    return F.least(left, right) * similarity.denominator >= (
        F.greatest(left, right) * similarity.numerator
    )


def _confirmed(pairs: DataFrame, active: DataFrame, sets: DataFrame, s: Fraction) -> DataFrame:
    """Those pairs (a, b) that are as similar as asked, by sketches first, then by full sets."""
    side = lambda df, key, value: df.select(
        F.col("rep").alias(key), F.col(value).alias(f"{value}_{key}")
    )
    both = pairs.join(side(active, "a", "sketch"), "a").join(side(active, "b", "sketch"), "b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, SKETCH)
    common = F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b"))
    enough = F.size(common) * SKETCH >= F.size(union) * _least_common(SKETCH, s)
    likely = both.where(enough).select("a", "b")
    full = written(likely, "likely")
    full = full.join(side(sets, "a", "shingles"), "a").join(side(sets, "b", "shingles"), "b")
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.size("shingles_a") + F.size("shingles_b") - common
    return full.where(common * s.denominator >= union * s.numerator).select("a", "b")


def _active(classes: DataFrame, s: Fraction) -> tuple[DataFrame, DataFrame]:
    """Documents that may have a partner, and their entries in the inverted lists.

    ``own`` counts values that no other document retains.
    """
    retained = classes.select("rep", F.explode("sketch").alias("value"))
    shared = retained.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = written(shared, "lists")
    first = classes.select("rep", F.explode(F.slice("sketch", 1, LISTED)).alias("value"))
    entries = written(first.join(shared, "value"), "entries")
    listed = F.least("n_shingles", F.lit(LISTED))
    least = _least_common(LISTED, s)
    enough = F.when(F.col("n_shingles") > LISTED, least).otherwise(
        F.ceil(F.col("n_shingles") * s.numerator / s.denominator)
    )
    counts = entries.groupBy("rep").agg(
        F.count("*").alias("shared"), F.count_if(F.col("df") > LONG_LIST).alias("common")
    )
    # With so many values outside long lists, partners share one of them.
    rare_needed = F.ceil(listed * (LISTED - least + 1) / LISTED)
    active = classes.join(counts, "rep").where(F.col("shared") >= enough)
    active = active.select(
        "rep",
        "n_shingles",
        "sketch",
        (listed - F.col("shared")).alias("own"),
        (listed - F.col("common") < rare_needed).alias("is_common"),
    )
    active = written(active, "active")
    slim = active.select("rep", "n_shingles", "own", "is_common")
    return active, written(entries.join(slim, "rep"), "active-entries")


def _prefixes(active: DataFrame, sets: DataFrame, s: Fraction) -> DataFrame:
    """Documents of common text under the rarest shingles of their full sets.

    All order their shingles alike, by how many of them hold one. Similar documents
    share a shingle among the first ``n - s * n + 1``, so this is exact.
    A document that holds more shingles of its own than that has no partner here.
    """
    common = active.where("is_common").select("rep", "n_shingles")
    held = written(
        sets.join(common, "rep").select("rep", "n_shingles", F.explode("shingles").alias("value")), "held"
    )
    counts = written(held.groupBy("value").agg(F.count("*").alias("df")), "holders")
    rarest = Window.partitionBy("rep").orderBy("df", "value")
    rows = held.join(counts, "value").withColumn("place", F.row_number().over(rarest))
    first = F.floor(F.col("n_shingles") * (s.denominator - s.numerator) / s.denominator) + 1
    return written(rows.where((F.col("place") <= first) & (F.col("df") > 1)), "prefixes")


def _meeting(active: DataFrame, entries: DataFrame, prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep in long lists only documents of common text that can have a partner there."""
    common = written(prefixes.select("rep", F.lit(True).alias("meets")).distinct(), "common")
    marked = lambda df: df.join(common, "rep", "left").withColumn(
        "is_common", F.coalesce("meets", F.lit(False))
    )
    entries = marked(entries).where((F.col("df") <= LONG_LIST) | F.col("is_common"))
    return marked(active).drop("meets"), entries.drop("meets")


def _typical_links(entries: DataFrame, s: Fraction) -> DataFrame:
    """Each entry of a list with the entry that has the fewest values of its own."""
    typical = entries.groupBy("value").agg(F.min(F.struct("own", "rep", "n_shingles")).alias("t"))
    typical = written(
        typical.select("value", F.col("t.rep").alias("t_rep"), F.col("t.n_shingles").alias("t_n")),
        "typical",
    )
    found = entries.join(typical, "value").where(F.col("rep") != F.col("t_rep"))
    found = found.where(_alike("n_shingles", "t_n", s))
    return _overlaps(found.select(_least("rep", "t_rep"), _greatest("rep", "t_rep")))


def _least(x: str, y: str) -> F.Column:
    return F.least(x, y).alias("a")


def _greatest(x: str, y: str) -> F.Column:
    return F.greatest(x, y).alias("b")


def _overlaps(pairs: DataFrame) -> DataFrame:
    """Every pair once, with the number of lists it was found in."""
    return pairs.groupBy("a", "b").agg(F.count("*").alias("overlap"))


def _pairs_within(lists: DataFrame, s: Fraction) -> DataFrame:
    """Pairs of one list whose members are not yet connected.

    ``place`` is where a member has the list's value in its order. What follows it in both
    bounds the overlap of a pair that meets there first.
    """
    ends = lists.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    split = written(ends.where("lo < hi").select("value"), "split-lists")
    rows = written(lists.join(split, "value"), "split-entries")
    side = lambda name: rows.select(
        "value",
        F.col("rep").alias(name),
        F.col("n_shingles").alias(f"n_{name}"),
        F.col("place").alias(f"at_{name}"),
        F.col("component").alias(f"c_{name}"),
    )
    left = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) + 1
    enough = left * (s.numerator + s.denominator) >= (F.col("n_a") + F.col("n_b")) * s.numerator
    found = side("a").join(side("b"), "value").where("a < b AND c_a <> c_b")
    return found.where(_alike("n_a", "n_b", s) & enough).select("a", "b")


def links(docs: DataFrame, sketched: DataFrame, similarity: Fraction = SIMILARITY) -> DataFrame:
    """Pairs (a, b) of class representatives that are similar, enough to connect all that are.

    ``sketched`` is what ``sketches`` gives for the same documents. A class is
    represented by its least doc_id.
    """
    known = sketched.where("doc_id IS NOT NULL AND class IS NOT NULL")
    reps = known.groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    classes = known.join(reps, ["class", "doc_id"]).dropDuplicates(["class"])
    classes = classes.withColumnRenamed("doc_id", "rep")
    classes = written(classes, "classes")
    active, entries = _active(classes, similarity)
    wanted = classes.join(active.select("rep"), "rep", "left_semi").select("rep", "class")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(wanted, "rep")
    sets = texts.mapInArrow(_sets, "rep long, shingles array<long>")
    sets = written(sets.dropDuplicates(["rep", "shingles"]), "sets")
    prefixes = _prefixes(active, sets, similarity)
    active, entries = _meeting(active, entries, prefixes)
    active, entries = written(active, "active"), written(entries, "entries")
    first = written(_confirmed(_typical_links(entries, similarity), active, sets, similarity), "links")
    known = written(components(first), "components")
    placed = lambda df: df.join(known.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    columns = ("value", "rep", "n_shingles", "place")
    short = entries.where(F.col("df") <= LONG_LIST).withColumn("place", F.lit(0)).select(*columns)
    rest = _pairs_within(placed(short), similarity).unionByName(
        _pairs_within(placed(prefixes.select(*columns)), similarity)
    )
    second = _confirmed(_overlaps(rest), active, sets, similarity)
    return first.unionByName(second)


def near_duplicates(docs: DataFrame, similarity: Fraction = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, text_id, n_shingles, component_id, kept.

    ``component_id`` is the least doc_id reachable over links of at least this
    similarity, ``kept`` is whether it is the document's own. ``text_id`` is a
    hash of the text.
    """
    if not Fraction(80, 100) <= similarity <= 1:
        raise ValueError("similarity must be from 0.8 to 1")
    with temporary(docs.sparkSession) as keep:
        return keep(_judged(docs, similarity), "near-duplicates")


def _judged(docs: DataFrame, similarity: Fraction) -> DataFrame:
    sketched = written(sketches(docs), "sketches")
    found = written(components(links(docs, sketched, similarity)), "components")
    known = sketched.where("doc_id IS NOT NULL AND class IS NOT NULL").select("doc_id", "class")
    reps = known.groupBy("class").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    placed = reps.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    placed = placed.where("component IS NOT NULL OR rep <> last")
    placed = written(placed.select("class", F.coalesce("component", "rep").alias("component")), "placed")
    own = F.coalesce("component", "doc_id")
    rows = sketched.join(placed, "class", "left").select(
        "doc_id", "text_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id")
    )
    return rows.withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def kept_documents(docs: DataFrame, similarity: Fraction = SIMILARITY) -> DataFrame:
    """The documents that are kept, with all their columns: one of each group of near duplicates.

    Every distinct pair of id and text is a document here, with or without an id. Rows that are equal in both are
    one, and any one of them stays. Of a group the document with the least key stays; the key is its id,
    or a hash of id and text where the id is null or has several texts. Texts without words are like nothing.
    """
    spark = docs.sparkSession
    doc_id, text_id = F.col("doc_id").cast("long"), F.xxhash64("text")
    with temporary(spark) as keep:
        ids = docs.select(doc_id.alias("doc_id"), text_id.alias("text_id")).where("doc_id IS NOT NULL")
        texts = ids.groupBy("doc_id").agg(F.min("text_id").alias("lo"), F.max("text_id").alias("hi"))
        shared = written(texts.where("lo <> hi").select("doc_id"), "shared-ids")
        several = not shared.isEmpty()
        shared = keep(shared, "shared-ids") if several else None
        keyed = _keyed(docs, shared, "key", "text").select(F.col("key").alias("doc_id"), "text")
        found = written(near_duplicates(keyed, similarity), "judged")
        out = keep(found.where("NOT kept").select("doc_id").distinct(), "dropped")
        twice = found.where("kept").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
        twice = written(twice, "repeated")
        twice = None if twice.isEmpty() else keep(twice, "repeated")
    (key,) = unused(docs, "key")
    kept = _keyed(docs, shared, key, *docs.columns)
    named = lambda df: df.toDF(key)
    kept = kept.join(named(out), key, "left_anti")
    if twice is not None:
        one = kept.join(named(twice), key, "left_semi").dropDuplicates([key])
        kept = kept.join(named(twice), key, "left_anti").unionByName(one)
    return kept.select(*(F.col(f"`{name}`") for name in docs.columns))


def _keyed(docs: DataFrame, shared: DataFrame | None, key: str, *columns: str) -> DataFrame:
    """Columns of the documents, and a key of their own that is never null."""
    doc_id = F.col("doc_id").cast("long")
    hashed = F.xxhash64(doc_id, "text", F.lit("document"))
    wanted = [F.col(f"`{name}`") for name in columns]
    if shared is None:
        return docs.select(*wanted, F.coalesce(doc_id, hashed).alias(key))
    (flag,) = unused(docs, "shared")
    of = F.struct(F.col("doc_id").alias("id")).alias(flag)
    rows = docs.join(shared.select(of), doc_id == F.col(f"{flag}.id"), "left")
    own = F.when(F.col(flag).isNull(), doc_id)
    return rows.select(*wanted, F.coalesce(own, hashed).alias(key))
