"""MinHash near-dedup with banding, signature and full-set verification, and components (operator 6).

Rows with the same shingle set are one class, known by a hash of its set, and linked as such.
Each class has HASHES universal hash minima; classes that agree on all minima of a band meet
in that band. First every class of a band is compared with the band's most central class (a
star, not all pairs): estimated from the signatures, then confirmed on the full shingle sets.
Confirmed links give components. Only bands whose classes still lie in several components are
then compared within, in bounded blocks: by signature first, and what may be linked to another
component by exact intersections of full sets. A block hands out the links that join its
components, not its pairs; no pair of classes that meets in a band is left unjudged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import KEY, mix64, ngrams_of, one_per_group, row_key, rows_of, text_slices, without_rows, with_key, words_of, written
from fleetlens.llm.components import connected_components

#: 28 bands of 5 minima: a pair at similarity 0.85 misses all bands with probability 7e-8.
BANDS, ROWS = 28, 5
HASHES = BANDS * ROWS
#: Pairs whose signatures agree on a smaller share are not compared on full sets (8 standard
#: deviations below 0.8 and 0.85 for 140 minima would be 0.53 and 0.61).
LEAST_ESTIMATE = {80: 0.58, 85: 0.65}
#: Classes of one band compared within one task; larger bands are split into pairs of blocks.
BLOCK = 2048

_RNG = np.random.Generator(np.random.PCG64(71))
_A = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def _row_shingles(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every row: ``words`` consecutive words, or the whole
    sequence of a shorter text; none without words."""
    for _, rows, data, offsets in text_slices(column):
        hashes, at = words_of(data, offsets, fold_case=True)
        grams = ngrams_of(hashes, words)
        for i in range(rows):
            a, b = at[i], at[i + 1]
            if b - a >= words:
                yield np.unique(grams[a : b - words + 1])
            elif b > a:
                yield ngrams_of(hashes[a:b], int(b - a)) ^ np.uint64(b - a)
            else:
                yield hashes[:0]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES 16-bit minima (hashed) of each non-empty set."""
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    values = np.concatenate(sets)
    out = np.empty((len(sets), HASHES), np.uint16)
    for i in range(HASHES):
        out[:, i] = mix64(np.minimum.reduceat(values * _A[i] + _B[i], starts)) >> np.uint64(48)
    return out


def _band_keys(sigs: np.ndarray) -> np.ndarray:
    keys = np.empty((len(sigs), BANDS), np.uint64)
    for b in range(BANDS):
        keys[:, b] = ngrams_rows(sigs[:, b * ROWS : (b + 1) * ROWS].astype(np.uint64), b)
    return keys.view(np.int64)


def ngrams_rows(columns: np.ndarray, salt: int) -> np.ndarray:
    h = np.full(len(columns), salt + 1, np.uint64)
    for j in range(columns.shape[1]):
        h = mix64(h ^ columns[:, j]) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(h)


_ROWS_SCHEMA = "doc_id long, k_id long, k_text long, n_shingles long, node long, sig binary"


def _described(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, nodes, sigs = [], [], []
        group: list[np.ndarray] = []
        weight = 0

        def flush() -> None:
            nonlocal group, weight
            if group:
                sigs.extend(row.tobytes() for row in signatures(group))
            group, weight = [], 0

        for s in _row_shingles(batch.column("text"), words):
            sizes.append(len(s))
            if not len(s):
                flush()
                nodes.append(None)
                sigs.append(None)
                continue
            # a hash of the set: sums of two mixes of its members and its size
            total = int(mix64(s).sum()) ^ (int(mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum()) * 0x9E3779B97F4A7C15 + len(s))
            nodes.append(int(np.uint64(total & (1 << 64) - 1).view(np.int64)))
            group.append(s)
            weight += len(s)
            if weight > 500_000:
                flush()
        flush()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("k_id"), batch.column("k_text"), pa.array(sizes, pa.int64()),
             pa.array(nodes, pa.int64()), pa.array(sigs, pa.binary())],
            ["doc_id", "k_id", "k_text", "n_shingles", "node", "sig"],
        )


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)
        keys = _band_keys(sigs)
        nodes = np.repeat(batch.column("node").to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(nodes)], ["band", "node"])


def _estimated(least: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v) whose signatures agree on a share of at least ``least``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES) for c in ("sig_u", "sig_v"))
        yield batch.select(["u", "v"]).filter(pa.array((a == b).mean(1) >= least))


def _set_rows(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            sets = [s.tobytes() for s in _row_shingles(part.column("text"), words)]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.large_binary())], ["node", "set"])


def _confirmed(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = []
        for a, b in zip(batch.column("set_u"), batch.column("set_v")):
            x, y = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            good.append(100 * both >= percent * (len(x) + len(y) - both))
        yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))


class _Judge:
    """Judges candidate pairs of classes; every class's set is derived from one of its rows."""

    def __init__(self, spark: SparkSession, docs: DataFrame, classes: DataFrame, words: int, percent: int):
        self.spark, self.docs, self.classes = spark, docs, classes
        self.words, self.percent = words, percent

    def _joined(self, pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
        for end in "uv":
            pairs = pairs.join(table.select(F.col("node").alias(end), F.col(column).alias(f"{column}_{end}")), end)
        return pairs

    def sets(self, nodes: DataFrame, name: str) -> DataFrame:
        """node and set (sorted shingle hashes) of the classes named, from the text of one row each."""
        words = self.words
        wanted = written(self.spark, self.classes.join(nodes, "node").select(*KEY, "node"), f"{name}-wanted")
        texts = rows_of(self.docs, wanted).dropDuplicates(["node"]).select("node", "text")
        return written(self.spark, texts.mapInArrow(lambda x: _set_rows(words, x), "node long, set binary"), f"{name}-sets")

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (u, v) that are similar: by size, by signature, then on the full sets."""
        pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        sized = self._joined(pairs, self.classes, "n_shingles")
        small, large = F.least("n_shingles_u", "n_shingles_v"), F.greatest("n_shingles_u", "n_shingles_v")
        sized = sized.where(100 * small >= self.percent * large).select("u", "v")
        least, percent = LEAST_ESTIMATE.get(self.percent, 0.0), self.percent
        likely = written(
            self.spark,
            self._joined(sized, self.classes, "sig").mapInArrow(lambda x: _estimated(least, x), "u long, v long"),
            f"{name}-pairs",
        )
        nodes = likely.select(F.col("u").alias("node")).unionByName(likely.select(F.col("v").alias("node"))).distinct()
        sets = self.sets(nodes, name)
        return written(
            self.spark,
            self._joined(likely, sets, "set").mapInArrow(lambda x: _confirmed(percent, x), "u long, v long"),
            f"{name}-links",
        )


def _meeting(members: pd.DataFrame, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, places after i) of the pairs of one block, or between two blocks, whose components differ
    and whose sizes allow a link."""
    comps, sides, sizes = (members[c].to_numpy() for c in ("component", "side", "n_shingles"))
    for i in range(len(members)):
        c, s, n = comps[i + 1 :], sides[i + 1 :], sizes[i + 1 :]
        ok = (c != comps[i]) & ((s != sides[i]) | (sides[i] == 0))
        ok &= 100 * np.minimum(n, sizes[i]) >= percent * np.maximum(n, sizes[i])
        yield i, np.flatnonzero(ok) + i + 1


_SUSPECT = "band long, lo int, hi int, side int, node long, component long, n_shingles long"


def _suspects(percent: int, least: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of each block (rows sorted by block) that by signature may be linked with one of another component,
    and meet it in no earlier band. Many small blocks are judged at once, in whole batches."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        starts = _block_starts(held)
        if len(starts) > 1:  # the last block may go on
            yield from _suspects_of(percent, least, held.slice(0, int(starts[-1])))
            held = held.slice(int(starts[-1]))
    if held is not None and held.num_rows:
        yield from _suspects_of(percent, least, held)


def _block_starts(rows: pa.Table) -> np.ndarray:
    if not rows.num_rows:
        return np.zeros(0, np.int64)
    names = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("band", "lo", "hi")])
    return np.flatnonzero(np.concatenate([[True], (names[:, 1:] != names[:, :-1]).any(0)]))


#: Blocks of at most so many classes are judged together, pair distance by pair distance.
SMALL_BLOCK = 64


def _suspects_of(percent: int, least: float, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    band, sides, comps, sizes = (rows.column(c).to_numpy() for c in ("band", "side", "component", "n_shingles"))
    sigs = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)
    starts = _block_starts(rows)
    count = np.diff(np.append(starts, len(band)))
    keys = _band_keys(sigs)
    # the place of a block's own band: where all its classes have that key
    own = np.logical_and.reduceat(keys == band[:, None], starts, axis=0).argmax(1)
    block = np.repeat(np.arange(len(starts)), count)
    left = count[block] - (np.arange(len(band)) - starts[block])  # classes from this one to the block's end
    near = np.zeros(len(band), bool)

    def judge(i: np.ndarray, j: np.ndarray) -> None:
        ok = (comps[i] != comps[j]) & ((sides[i] != sides[j]) | (sides[i] == 0))
        ok &= 100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j])
        i, j = i[ok], j[ok]
        # a pair that meets in an earlier band is judged there
        fresh = ~((keys[i] == keys[j]) & (np.arange(BANDS) < own[block[i]][:, None])).any(1)
        i, j = i[fresh], j[fresh]
        likely = (sigs[i] == sigs[j]).sum(1) >= least * HASHES
        near[i[likely]] = near[j[likely]] = True

    small = count[block] <= SMALL_BLOCK
    for d in range(1, int(count[count <= SMALL_BLOCK].max(initial=0))):
        i = np.flatnonzero(small & (left > d))
        judge(i, i + d)
    for b in np.flatnonzero(count > SMALL_BLOCK):
        one = slice(int(starts[b]), int(starts[b] + count[b]))
        # small numbers that tell the keys of the earlier bands apart
        early = np.empty((count[b], own[b]), np.uint16 if count[b] < 1 << 16 else np.uint32)
        for c in range(own[b]):
            early[:, c] = np.unique(keys[one, c], return_inverse=True)[1]
        c, s, n, sig, found = comps[one], sides[one], sizes[one], sigs[one], near[one]
        for i in range(count[b] - 1):
            ok = (c[i + 1 :] != c[i]) & ((s[i + 1 :] != s[i]) | (s[i] == 0))
            ok &= 100 * np.minimum(n[i + 1 :], n[i]) >= percent * np.maximum(n[i + 1 :], n[i])
            others = np.flatnonzero(ok) + i + 1
            if len(others):
                others = others[~(early[others] == early[i]).any(1)]
                likely = others[(sig[others] == sig[i]).sum(1) >= least * HASHES]
                found[likely] = True
                found[i] |= len(likely) > 0
    yield from rows.select([f.split()[0] for f in _SUSPECT.split(", ")]).filter(pa.array(near)).to_batches()


def _intersections(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over the shingles met twice."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    again = count > 1
    place = np.cumsum(again) - 1
    rows, at = rows[again[at]], place[at[again[at]]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(again.sum()), columns):
        own = (at >= first) & (at < first + columns)
        matrix = np.zeros((len(sets), columns), np.float32)
        matrix[rows[own], at[own] - first] = 1
        out += matrix @ matrix.T
    return out


def _links(percent: int, members: pd.DataFrame) -> pd.DataFrame:
    """Links, confirmed on full sets, that join the components of a block: a forest of them is enough."""
    sets = [np.frombuffer(x, np.uint64) for x in members["set"]]
    both = _intersections(sets)
    nodes, comps, sizes = (members[c].to_numpy() for c in ("node", "component", "n_shingles"))
    parent: dict[int, int] = {int(c): int(c) for c in comps}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    us, vs = [], []
    for i, others in _meeting(members, percent):
        linked = others[100 * both[i, others] >= percent * (sizes[others] + sizes[i] - both[i, others])]
        _, first = np.unique(comps[linked], return_index=True)
        for j in linked[first]:
            a, b = find(int(comps[i])), find(int(comps[j]))
            if a != b:
                parent[b] = a
                us.append(nodes[i])
                vs.append(nodes[j])
    return pd.DataFrame({"u": pd.array(us, "int64"), "v": pd.array(vs, "int64")})


def near_dedup(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, KEY, n_shingles, component_id, kept, group (the component's
    own name, null for a row that is linked with nothing for want of words).

    Texts are lower-cased (A-Z), words are split at ASCII white space. Two rows are linked when
    100 * intersection >= percent * union of their shingle sets. component_id is the smallest
    doc_id of the linked component; kept where it is the row's own. A null or empty text, or
    one without words, is linked with nothing and stays. Null ids never name a component unless
    it has no other; rows that repeat an id and a text share their fate. Texts of any length
    count whole; an empty table gives no row; other columns are ignored.
    """
    keyed = with_key(docs)
    rows = written(spark, keyed.mapInArrow(lambda x: _described(words, x), _ROWS_SCHEMA), "rows")
    some = rows.where("node is not null")
    one = some.groupBy("node").agg(F.min(F.struct(*KEY)).alias("k"), F.min("doc_id").alias("least_id"), F.min("n_shingles").alias("n_shingles"))
    one = written(spark, one.select("node", "k.*", "least_id", "n_shingles"), "one")
    classes = written(
        spark,
        some.select(*KEY, "sig").join(one, KEY).dropDuplicates(["node"]).select("node", *KEY, "n_shingles", "sig"),
        "classes",
    )
    bands = written(spark, classes.select("node", "sig").mapInArrow(_banded, "band long, node long"), "bands")
    met = written(spark, bands.groupBy("band").count().where("count > 1"), "met")
    shared = written(spark, bands.join(met, "band"), "shared")
    weight = shared.groupBy("node").agg(F.sum("count").alias("weight"))
    central = shared.join(weight, "node").groupBy("band").agg(F.max(F.struct("weight", "node")).alias("c"))
    central = written(spark, central, "central")
    star = shared.join(central, "band").select(F.col("c.node").alias("u"), F.col("node").alias("v")).where("u != v")
    judge = _Judge(spark, keyed, classes, words, percent)
    links = judge.links(star, "star")

    joined = connected_components(spark, links)
    placed = shared.join(joined, "node", "left").select(
        "band", "node", "count", F.coalesce("component", "node").alias("component")
    )
    mixed = placed.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a != b").select("band")
    mixed = written(spark, mixed, "mixed")
    open_bands = written(spark, placed.join(mixed, "band"), "open")
    blocks = F.ceil(F.col("count") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = (
        open_bands.join(classes.select("node", "n_shingles", "sig"), "node")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        # each block meets itself and, once, every other block
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lo", F.least("own", "other"))
        .withColumn("hi", F.greatest("own", "other"))
        .withColumn("side", F.when(F.col("lo") == F.col("hi"), 0).when(F.col("own") == F.col("lo"), 1).otherwise(2))
        .select("band", "lo", "hi", "side", "node", "component", "n_shingles", "sig")
        .repartition(parts, "band", "lo", "hi")
        .sortWithinPartitions("band", "lo", "hi")
    )
    least = LEAST_ESTIMATE.get(percent, 0.0)
    suspects = written(spark, members.mapInArrow(lambda x: _suspects(percent, least, x), _SUSPECT), "suspects")
    sets = judge.sets(suspects.select("node").distinct(), "rest")
    more = (
        suspects.join(sets, "node")
        .repartition(parts, "band", "lo", "hi")
        .groupBy("band", "lo", "hi")
        .applyInPandas(lambda pdf: _links(percent, pdf), "u long, v long")
    )
    final = connected_components(spark, links.unionByName(written(spark, more, "rest-links")))

    least_of = (
        one.select("node", "least_id")
        .join(final, "node", "left")
        .select("node", "least_id", F.coalesce("component", "node").alias("component"))
    )
    least_of = written(spark, least_of, "placed")
    names = written(spark, least_of.groupBy("component").agg(F.min("least_id").alias("component_id")), "names")
    named = written(spark, least_of.join(names, "component").select("node", "component_id", F.col("component").alias("group")), "named")
    out = some.drop("sig").join(named, "node").drop("node").unionByName(
        rows.where("node is null")
        .drop("sig", "node")
        .withColumn("component_id", F.col("doc_id"))
        .withColumn("group", F.lit(None).cast("long"))
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_dedup(spark, docs, words=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 0.8), with all its columns."""
    dropped = near_dedup(spark, docs).where("not kept").select(*KEY)
    return without_rows(docs, written(spark, dropped, "dropped"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """As drop_near_copies, but one row of each group also where ids repeat or are null."""
    wordless = ~F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    return one_per_group(spark, docs, near_dedup(spark, docs), apart=wordless)


SQL = """
with recursive split as (
    select doc_id, list_filter(
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
        lambda w: w <> '') as ws
    from documents
), shingles as (
    select distinct doc_id, array_to_string(ws[i : i + 2], ' ') as s
    from (select doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 2, least(len(ws), 1)))) as i from split)
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), pairs as (
    select a.doc_id as a, b.doc_id as b, count(*) as common
    from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
    select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * common >= 85 * (x.n + y.n - common)
), sides as (
    select a, b from links union all select b, a from links
), reach(doc_id, other) as (
    select a, b from sides union select r.doc_id, s.b from reach r join sides s on s.a = r.other
), least_of as (
    select doc_id, min(other) as other from reach group by doc_id
)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) as component_id,
       d.doc_id = component_id as kept
from documents d left join sizes using (doc_id) left join least_of using (doc_id)
"""
