"""Near-duplicate records: shingle sketches, banded buckets, star-shaped candidates, exact verification.

Each text's distinct shingles are hashed into one permutation of bins (OPH); an empty bin takes the value of a bin drawn
by its own number (optimal densification). Bands of bins give buckets. The record of least hash in a bucket is its hub,
and a bucket's candidates are kept as a star: one edge from each record to the hub. As the order is the same in all
buckets, records that share many buckets share few hubs. All records around a hub are then verified with each other on
their whole shingle sets, in blocks of bounded size, so that every two records of a bucket are compared, and every two
that share a bucket with a common hub; each two are compared under the least of their common hubs only.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.session import materialised
from quirelake.tables import few, latest_rows, spread, table

WORD = re.compile(r"[^\W_]+")
#: Words of a shingle, least similarity and least words of a text where a caller names none.
SHINGLE, SIMILARITY, LEAST_WORDS = 5, 0.8, 5
#: Copies of one and the same text that are listed in all pairs where a caller says nothing else.
COPIES = 50
#: Records of a slice, and shingles of one: a star's records are verified in blocks of two slices.
SLICE, SLICE_SHINGLES = 1000, 1_000_000
#: Columns of the dense tables in which a block counts its shared shingles.
COLUMNS = 4096
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Shingle hashes of a batch of texts."""

    def __init__(self, shingle: int, least_words: int):
        self.shingle, self.least = shingle, max(least_words, shingle)
        self.codes: dict[str, int] = {}

    def code(self, word: str) -> int:
        if len(self.codes) > 500_000:
            self.codes.clear()
        c = self.codes[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return c

    def sets(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of text, its distinct shingle hashes in order, kept indices): two flat arrays and the texts long enough."""
        flat: list[int] = []
        bounds, kept, get, code = [0], [], self.codes.get, self.code
        for i, t in enumerate(texts):
            words = WORD.findall(t.lower()) if t else ()
            if len(words) >= self.least:
                flat += [get(w) or code(w) for w in words]
                bounds.append(len(flat))
                kept.append(i)
        kept_ = np.array(kept, dtype=np.int64)
        if not kept:
            return np.empty(0, np.int64), np.empty(0, np.uint64), kept_
        words_, ends = np.array(flat, dtype=np.uint64), np.array(bounds)
        n = len(words_) - self.shingle + 1
        h = np.zeros(n, dtype=np.uint64)
        for k in range(self.shingle):
            h = _stir(h * np.uint64(31) + words_[k : k + n] + np.uint64(k))
        owner = np.repeat(np.arange(len(kept)), np.diff(ends))[:n]
        whole = np.arange(n) + self.shingle <= ends[owner + 1]
        owner, h = owner[whole], h[whole]
        order = np.lexsort((h, owner))
        owner, h = owner[order], h[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
        return owner[new], h[new], kept_


class Sketcher:
    """Band keys of shingle sets."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows

    def keys(self, owner: np.ndarray, shingles: np.ndarray, count: int) -> np.ndarray:
        empty = np.uint64(2**64 - 1)
        h = _stir(shingles)
        place = (h % np.uint64(self.bins)).astype(np.int64)
        sketch = np.full(count * self.bins, empty, dtype=np.uint64)
        at = owner * self.bins + place
        order = np.lexsort((h, at))
        at, h = at[order], h[order]
        first = np.ones(len(at), dtype=bool)
        first[1:] = at[1:] != at[:-1]
        sketch[at[first]] = h[first]
        sketch = sketch.reshape(count, self.bins)
        lacking = sketch == empty
        source, row, bin_, attempt = sketch.copy(), *np.nonzero(lacking), 1
        while len(row):
            donor = (_stir(bin_.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(attempt)) % np.uint64(self.bins)).astype(np.int64)
            value = source[row, donor]
            got = value != empty
            sketch[row[got], bin_[got]] = value[got]
            row, bin_, attempt = row[~got], bin_[~got], attempt + 1
        out = np.zeros((count, self.bands), dtype=np.uint64)
        for r in range(self.rows):
            out = _stir(out * np.uint64(31) + sketch[:, r :: self.rows][:, : self.bands] + np.arange(self.bands, dtype=np.uint64))
        return out.view(np.int64)


def _columns(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).alias("id"), F.col(text).alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")


def sketches(docs: DataFrame, shingle: int, least_words: int, bands: int, rows: int) -> DataFrame:
    """(id, set_a, set_b, same, size, bands): hashes of the whole shingle set (two) and of the text, shingles, band keys. Shorter texts have no row."""
    kind = dict(docs.dtypes)["id"]

    def run(parts):
        shingler, sketcher = Shingler(shingle, least_words), Sketcher(bands, rows)
        for part in parts:
            for cut in range(0, part.num_rows, 2000):
                some = part.slice(cut, 2000)
                owner, shingles, kept = shingler.sets(some.column(1).to_pylist())
                n = len(kept)
                if not n:
                    continue
                keys = sketcher.keys(owner, shingles, n)
                starts = np.searchsorted(owner, np.arange(n))
                total, mixed = np.add.reduceat(_stir(shingles), starts), np.bitwise_xor.reduceat(_stir(shingles + np.uint64(77)), starts)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(keys.reshape(-1)))
                texts = some.column(1).take(pa.array(kept)).to_pylist()
                same = np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in texts], dtype=np.uint64)
                hashes = [pa.array(x.view(np.int64)) for x in (total, mixed, same)]
                size = pa.array(np.diff(np.append(starts, len(owner))), pa.int64())
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(kept)), *hashes, size, flat], names=["id", "set_a", "set_b", "same", "size", "bands"])

    return spread(docs).mapInArrow(run, f"id {kind}, set_a long, set_b long, same long, size long, bands array<long>")


def _shingle_sets(docs: DataFrame, shingle: int, least_words: int) -> DataFrame:
    """(id, shingles): the distinct shingle hashes of each text."""
    kind = dict(docs.dtypes)["id"]

    def run(parts):
        shingler = Shingler(shingle, least_words)
        for part in parts:
            owner, shingles, kept = shingler.sets(part.column(1).to_pylist())
            if len(kept):
                ends = np.searchsorted(owner, np.arange(len(kept) + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(shingles.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(kept)), lists], names=["id", "shingles"])

    return docs.mapInArrow(run, f"id {kind}, shingles array<long>")


def _every_two(rows: DataFrame) -> DataFrame:
    """(a, b), a < b: every two values of a group, from (g, v, n) rows with the group's size. Large groups are salted."""
    slices = F.ceil(F.col("n") / SLICE)
    left = rows.select("g", F.pmod(F.xxhash64("v"), slices).alias("s"), F.col("v").alias("a"))
    right = rows.select("g", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)).alias("s"), F.col("v").alias("b"))
    return left.join(right, ["g", "s"]).filter("a < b").select("a", "b")


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and values of a list column."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    bounds = array.offsets.to_numpy()
    return bounds - bounds[0], array.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]]


def shared_counts(bounds: np.ndarray, values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """(left x right) how many values the rows' lists share; a list holds no value twice.

    Values that stand in one list only are left out, the rest are counted by products of dense tables, ``COLUMNS``
    values at a time.
    """
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.append(True, values[1:] != values[:-1])
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1
    column, owner = column[often], owner[often]
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    if not len(column):
        return out
    column = np.unique(column, return_inverse=True)[1]
    for first in range(0, int(column[-1]) + 1, COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        dense = np.zeros((len(bounds) - 1, COLUMNS), dtype=np.float32)
        dense[owner[a:b], column[a:b] - first] = 1
        out += dense[left] @ dense[right].T
    return out


def _block(rows: pa.Table, hub, split: bool, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, row, similarity) of a block's verified pairs, without those that a lesser hub of both verifies."""
    bounds, values = _lists(rows.column("shingles"))
    n = len(bounds) - 1
    second = rows.column("second").to_numpy() if split else None
    left, right = (np.nonzero(~second)[0], np.nonzero(second)[0]) if split else (np.arange(n), np.arange(n))
    shared, sizes = shared_counts(bounds, values, left, right), np.diff(bounds)
    alike = shared / (sizes[left][:, None] + sizes[right][None, :] - shared)
    good = alike >= similarity - 1e-12
    if not split:
        good &= np.triu(np.ones((n, n), dtype=bool), 1)
    if good.any():
        other: dict = {}
        cells = [(r, other.setdefault(h, len(other))) for r, hs in enumerate(rows.column("hubs").to_pylist()) for h in hs if h < hub]
        if cells:
            held = np.zeros((n, len(other)), dtype=np.float32)
            held[tuple(np.array(cells).T)] = 1
            good &= held[left] @ held[right].T == 0
    i, j = np.nonzero(good)
    return left[i], right[j], alike[i, j]


def _verify(similarity: float):
    """Blocks of (hub, s1, s2), each in a row of its partition, to their verified pairs."""

    def pairs(held: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(held)
        key = {c: rows.column(c)[0].as_py() for c in ("hub", "s1", "s2")}
        i, j, alike = _block(rows, key["hub"], key["s1"] != key["s2"], similarity)
        ids = rows.column("rep").combine_chunks()
        a, b = ids.take(pa.array(i)), ids.take(pa.array(j))
        less = pc.less(a, b)
        return pa.RecordBatch.from_arrays([pc.if_else(less, a, b), pc.if_else(less, b, a), pa.array(alike)], names=["a", "b", "similarity"])

    def run(parts):
        held: list[pa.RecordBatch] = []
        last = None
        for part in parts:
            hubs = part.column("hub").to_pylist()
            keys = list(zip(hubs, part.column("s1").to_pylist(), part.column("s2").to_pylist()))
            at = 0
            while at < len(keys):
                end = at + 1
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if keys[at] != last and held:
                    yield pairs(held)
                    held = []
                last = keys[at]
                held.append(part.slice(at, end - at))
                at = end
        if held:
            yield pairs(held)

    return run


def verified(docs: DataFrame, stars: DataFrame, shingle: int, least_words: int, similarity: float) -> DataFrame:
    """(a, b, similarity): the pairs around each hub whose shingle sets share at least ``similarity``, each once.

    ``stars``: (rep, hubs, size). Only texts of a star are read into shingles, and only they are shuffled. A star with
    more than ``SLICE`` records, or with more shingles than so many slices hold, is cut into slices by hash, and every
    two slices are a block of their own, so no star is one task.
    """
    kind = dict(stars.dtypes)["rep"]
    ids = stars.select(F.col("rep").alias("id"))
    sets = _shingle_sets(docs.join(few(ids)[0], "id", "left_semi"), shingle, least_words).withColumnRenamed("id", "rep")
    flat = stars.select("rep", "size", F.explode("hubs").alias("hub"))
    load = flat.groupBy("hub").agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_w"))
    load = load.select("hub", F.greatest(F.ceil(F.col("_n") / SLICE), F.ceil(F.col("_w") / SLICE_SHINGLES)).alias("_slices"))
    large = materialised(load.filter("_slices > 1"), "large")
    cut = flat.select("rep", "hub").join(few(large)[0], "hub", "left").withColumn("_slices", F.coalesce("_slices", F.lit(1).cast("long")))
    own = F.pmod(F.xxhash64("rep"), F.col("_slices"))
    cut = cut.withColumn("own", own).withColumn("_t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slices") - 1)))
    blocks = cut.select("rep", "hub", F.least("own", "_t").alias("s1"), F.greatest("own", "_t").alias("s2"), (F.col("own") > F.col("_t")).alias("second"))
    rows = blocks.join(stars.select("rep", "hubs").join(sets, "rep"), "rep").select("hub", "s1", "s2", "second", "rep", "hubs", "shingles")
    tasks = max(stars.sparkSession.sparkContext.defaultParallelism, int(stars.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    laid = rows.repartition(tasks, "hub", "s1", "s2").sortWithinPartitions("hub", "s1", "s2")
    return laid.mapInArrow(_verify(similarity), f"a {kind}, b {kind}, similarity double")


class Links:
    """Verified links between the least keys of equal shingle sets, and who holds each set.

    links: (a, b, similarity) with a < b, both representatives; copies: (id, rep, n, same) for sets held more than once,
    ``same`` being equal for equal texts.
    """

    def __init__(self, docs: DataFrame, shingle: int, similarity: float, least_words: int, bands: int, rows: int):
        docs = docs.select("id", "text")
        sk = materialised(sketches(docs, shingle, least_words, bands, rows), "sketches")
        reps = materialised(sk.groupBy("set_a", "set_b").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.min("size").alias("size"), F.min_by("bands", "id").alias("bands")), "representatives")
        shared = materialised(reps.filter("n > 1").select("set_a", "set_b", "rep", "n"), "shared")
        self.copies = sk.select("id", "set_a", "set_b", "same").join(few(shared)[0], ["set_a", "set_b"]).select("id", "rep", "n", "same")
        places = reps.select("rep", "size", F.explode("bands").alias("k"))
        least = F.min(F.struct(F.xxhash64("rep").alias("h"), F.col("rep").alias("hub")))
        hubs = materialised(places.groupBy("k").agg(least.alias("_m"), F.count(F.lit(1)).alias("m")).filter("m > 1").select("k", "_m.hub"), "hubs")
        near = places.join(few(hubs)[0], "k")
        # A record has at most as many hubs as bands, so this list is bounded.
        stars = materialised(near.groupBy("rep").agg(F.min("size").alias("size"), F.collect_set("hub").alias("hubs")), "stars")
        self.links = materialised(verified(docs, stars, shingle, least_words, similarity), "links")


#: Bands and bins of each for a similarity of 0.6 and of 0.8: at the threshold 99.4 and 99.99 of 100 pairs share a bucket.
BANDS = {0.6: (64, 5), 0.8: (24, 5)}


def links(df: DataFrame, key: str, text: str, shingle: int = SHINGLE, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS) -> Links:
    """Links of a table's texts: every two that share a bucket, or a bucket with a common hub, are verified.

    Words are the longest runs of letters and digits, lower-cased. Null keys, null texts and texts with fewer than
    ``least_words`` words have no links. Keys must be unique.
    """
    bands, rows = BANDS.get(similarity) or BANDS[0.6 if similarity < 0.8 else 0.8]
    return Links(_columns(df, key, text), shingle, similarity, least_words, bands, rows)


def all_pairs(found: Links, copies: int | None = COPIES) -> DataFrame:
    """(a, b, similarity): every linked pair of records, a < b.

    Up to ``copies`` copies of one text take part in all pairs; where more hold it, the least key stands for them, they
    are listed as pairs with it, and ``groups`` names each one's ``class_key``, by which the rest can be joined. With
    None every two copies are listed, however many. Texts that differ take part in all pairs, though their shingles be
    the same.
    """
    texts = found.copies.groupBy("rep", "same").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("held"))
    held = materialised(found.copies.select("id", "rep", "same").join(texts, ["rep", "same"]), "copies")
    beyond = F.lit(False) if copies is None else (F.col("held") > copies) & (F.col("id") != F.col("first"))
    stars = held.filter(beyond).select(F.col("first").alias("a"), F.col("id").alias("b"))
    members = held.filter(~beyond).select("rep", "id")
    sizes = materialised(members.groupBy("rep").agg(F.count(F.lit(1)).alias("n")), "sizes")
    members = materialised(members.join(sizes, "rep"), "members")
    slices = F.ceil(F.col("n") / SLICE)
    sliced = members.select("rep", F.pmod(F.xxhash64("id"), slices).alias("s"), "id")
    out = found.links
    for end, name in (("a", "x"), ("b", "y")):
        cut = out.join(sizes.withColumnRenamed("rep", end), end, "left").withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(slices, F.lit(1)) - 1))).drop("n")
        out = cut.join(sliced.toDF(end, "s", name), [end, "s"], "left").filter(F.col(name).isNotNull() | (F.col("s") == 0)).withColumn(name, F.coalesce(name, end)).drop("s")
    between = out.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "similarity")
    twins = _every_two(members.select(F.col("rep").alias("g"), F.col("id").alias("v"), "n")).unionByName(stars)
    return between.unionByName(twins.select("a", "b", F.lit(1.0).alias("similarity")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, group_key): the least id reachable over edges (a, b), for every id that has an edge.

    Each round takes the least label of the neighbours and then the label's own label, so long chains shrink by halves.
    Labels that still change after ``rounds`` rounds are an error, not a result.
    """
    ends = materialised(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "ends")
    labels = materialised(ends.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")), "labels")
    for _ in range(rounds):
        near = ends.join(labels, ends.b == labels.id).groupBy("a").agg(F.min("label").alias("m"))
        step = labels.join(near, labels.id == near.a, "left").select("id", "label", F.least("label", F.coalesce("m", "label")).alias("new"))
        jump = labels.select(F.col("id").alias("new"), F.col("label").alias("far"))
        moved = materialised(step.join(jump, "new", "left").select("id", "label", F.least("new", F.coalesce("far", "new")).alias("new")), "labels")
        changed = moved.filter("new <> label").limit(1).count()
        labels = moved.select("id", F.col("new").alias("label"))
        if not changed:
            return labels.select("id", F.col("label").alias("group_key"))
    raise RuntimeError(f"labels still change after {rounds} rounds")


def groups(found: Links) -> DataFrame:
    """(id, group_key, class_key, links, copies): one row for each record of a group.

    class_key: the least key that holds the same text; links: how many other shingle sets its own is linked with, all of
    them counted; copies: how many records hold its shingle set.
    """
    ends = found.links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    labels = components(found.links).withColumnRenamed("id", "rep")
    first = found.copies.groupBy("rep", "same").agg(F.min("id").alias("class_key"))
    held = found.copies.join(first, ["rep", "same"]).select("id", "rep", "class_key", F.col("n").alias("copies"))
    single = ends.join(held.select("rep").distinct(), "rep", "left_anti").select(F.col("rep").alias("id"), "rep", F.col("rep").alias("class_key"), F.lit(1).cast("long").alias("copies"))
    rows = held.unionByName(single).join(labels, "rep", "left").join(ends, "rep", "left")
    return rows.select("id", F.coalesce("group_key", "rep").alias("group_key"), "class_key", F.coalesce("links", F.lit(0)).alias("links"), "copies")


def _records(spark: SparkSession, folder: str) -> list[tuple[str, DataFrame]]:
    mails = latest_rows(table(spark, folder, "df_exploded").select(F.col("message_id").alias("id"), F.col("email_original_message").alias("text"), "ingested_at"), "id", "ingested_at")
    files = latest_rows(table(spark, folder, "final_df_summaries").select(F.expr("try_cast(file_id AS long)").alias("id"), F.col("original_text").alias("text"), "time_processed"), "id", "time_processed")
    return [("df_exploded", mails), ("final_df_summaries", files)]


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """(src_table, key_a, key_b): pairs of at least 30 words each that share 0.6 of their word triples."""
    parts = [all_pairs(links(df, "id", "text", 3, 0.6, 30)).select(F.lit(name).alias("src_table"), F.col("a").alias("key_a"), F.col("b").alias("key_b")) for name, df in _records(spark, folder)]
    return parts[0].unionByName(parts[1])


def p4_groups(spark: SparkSession, folder: str) -> DataFrame:
    """(src_table, row_key, group_key, class_key, links, copies) of every record in a group, under the same similarity."""
    parts = [groups(links(df, "id", "text", 3, 0.6, 30)).select(F.lit(name).alias("src_table"), F.col("id").alias("row_key"), "group_key", "class_key", "links", "copies") for name, df in _records(spark, folder)]
    return parts[0].unionByName(parts[1])
