"""MinHash near-dedup with SetSketch registers, bands of register values, joint likelihood and exact verification.

1. Each text becomes the set of its word shingles. Equal sets are one node of the graph, however many copies they have.
2. A SetSketch of a node: for each register the smallest of exponential hash values, on an exponential scale and
   truncated. Bands of neighbouring registers are bucket keys; nodes of a bucket are likely to be alike.
3. Rounds over 2 and 30 bands. In each bucket the nodes are first folded by component, on the map side; a
   node of the largest component is the pivot and meets the nodes of all others (a star, linear in the bucket). Pairs
   whose likelihood, given both sketches and set sizes, speaks against the similarity are left out; the others are
   compared on their full sets. What a round links is one component in the next, so a hot group takes part in one
   round and is then one row a bucket.
4. Where a bucket still holds several components, its pairs between components are compared: in small buckets by
   sketches first, then by 16 bits of each hash, and then on full sets, in large ones on full sets in square blocks of bounded size. Only nodes
   outside the bucket's largest component meet the others.
5. Components again; the smallest id of a component stays.

Nothing is gathered on the driver but counts; every list is a table in the shared folder, and goes when the tables made
from it are written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitweave.llm.common import Rolling, cut, drop, few, flat, keyed, mix, slices

#: Registers in a band, and bands. Sets of similarity 0.85 miss all bands with a chance of 1e-8, of 0.8 of 2e-6.
BAND, BANDS = 5, 32
REGISTERS = BAND * BANDS
#: The bands of each step of the search for nodes that share a bucket at all, and of each round of stars.
STEPS = ROUNDS = (range(2), range(2, BANDS))
#: Bits of the filter by which texts are picked: 4 MB, whatever their number. Texts it lets through in vain cost time only.
FILTER_BITS = 1 << 25
#: Base of the exponential scale: different sets agree on a register with a chance of (BASE - 1) / 4.
BASE, RATE = 1.02, 22.2
#: Standard errors by which the likeliest similarity may lie under the threshold without the pair being left out.
DOUBT = 5.0
#: Nodes of a bucket that are paired in one task, and nodes on a side of a block of larger buckets.
SMALL, BLOCK = 64, 256

TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, percent: int = 85) -> DataFrame:
    """Per row of `docs`: id, n_shingles, component_id (smallest id of its group), kept (id is that one).

    Words are runs without ASCII white space, A-Z lower-cased; a text's set holds its different shingles of `words`
    words, or the whole sequence if it has fewer. Sets are linked if 100 * intersection >= percent * union, and groups
    are what links reach. Null, empty and white texts have no set, are linked with nothing and are kept. A null id is
    larger than all others. Rows that share id and text are kept or dropped together. Other columns are not read.
    """
    return _grouped(docs, id_col, text_col, words, percent).drop("k1", "k2")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, all columns, without those of near_groups that are not kept."""
    gone = _grouped(docs, id_col, text_col, words, percent).filter("not kept").select("k1", "k2").distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(id_col).alias("k1"), F.xxhash64(text).alias("k2"))
    return rows.join(gone, ["k1", "k2"], "left_anti").select("row.*")


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    keys = keyed(docs, id_col, text_col)
    kind = keys.schema["id"].dataType.simpleString()
    sketched = cut(keys.mapInArrow(_sketches(words), f"id {kind}, k1 long, k2 long, n long, node binary, sketch binary"))
    full = sketched.filter("n > 0")
    nodes = full.groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min(F.struct("k1", "k2")).alias("key"))
    nodes = cut(nodes.select("node", "n", "sketch", "key.*"))
    rows = cut(sketched.drop("sketch"))
    drop(sketched)
    labels = _linked(keys, nodes, words, percent)
    drop(nodes)
    grouped = cut(few(rows.join(labels, "node", "left").select("id", "k1", "k2", "n", F.coalesce("label", "node").alias("group"))))
    drop(rows, labels)
    least = cut(few(grouped.filter("n > 0").groupBy("group").agg(F.min("id").alias("least"))))
    joined = grouped.withColumn("group", F.when(F.col("n") > 0, F.col("group"))).join(least, "group", "left")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id"))
    return joined.select(
        "id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
        "k1",
        "k2",
    )


def components(edges: DataFrame) -> DataFrame:
    """`node`, `label` (the smallest node it is connected with) of all ends of `edges` (a, b), as a scratch table.

    Each round takes the smallest label of the neighbours and then that label's own label; labels are written out
    between rounds. A node's own label is a row beside those of its neighbours, which spares a join. Partial
    aggregation keeps nodes with many neighbours from gathering them.
    """
    both = cut(few(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct()))
    labels = cut(few(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).withColumn("label", F.least("node", "label"))))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").select(F.col("a").alias("node"), "label", F.lit(None).cast("binary").alias("old"))
        near = near.union(labels.select("node", "label", F.col("label").alias("old")))
        near = few(near.groupBy("node").agg(F.max("old").alias("old"), F.min("label").alias("label")))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = cut(few(near.join(jump, "label", "left").select("node", "old", F.least("label", "further").alias("label"))))
        drop(labels)
        labels = step
        if step.filter("old <> label").isEmpty():
            drop(both)
            return step


def _linked(texts: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """`node` and `label` of every node that has a link, as a scratch table."""
    active = _active(nodes.select("node", "sketch"))
    sets = _full_sets(texts, nodes.join(active, "node").select("node", "n", "sketch", "k1", "k2"), words)
    drop(active)
    light = sets.select("node", "n", "sketch")

    labels = None
    for bands in ROUNDS:
        links = cut(_verified(_stars(_labelled(light, labels), bands, percent), sets, percent))
        labels = _joined(links, labels)

    # Buckets that still hold several components and have pairs that no star has tested.
    labelled = _labelled(light, labels)
    parts = _buckets(labelled, range(BANDS)).groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("bucket").agg(
        F.max(F.struct("n", "label"))["label"].alias("main"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("labels"), F.max("n").alias("most")
    )
    mixed = mixed.filter("size > 2 and labels > 1").withColumn("apart", F.col("size") - F.col("most"))
    mixed = cut(few(mixed.select("bucket", "main", "size", "apart")))
    buckets = _buckets(labelled, range(BANDS))
    small = buckets.join(mixed.filter(F.col("size") <= SMALL), "bucket").join(light, "node")
    small = small.select("bucket", "node", "label", "n", "sketch").repartition("bucket").sortWithinPartitions("bucket")
    possible = cut(_possible(small.mapInArrow(_across(percent), "a binary, b binary").distinct(), sets, percent))
    links = _verified(possible, sets, percent)
    large = mixed.filter(F.col("size") > SMALL)
    if not large.isEmpty():
        links = links.union(_blocks(buckets.join(large, "bucket"), sets, percent).distinct())
    labels = _joined(cut(links), labels)
    drop(mixed, possible, sets)
    return labels


def _full_sets(texts: DataFrame, chosen: DataFrame, words: int) -> DataFrame:
    """`node`, `n`, `sketch` and the full set (`grams`) of the chosen nodes, from the texts of their first rows.

    Texts are picked by a filter of the rows' keys where they are read, so that only the sets of (almost only) the
    chosen are shuffled. The filter is made on the executors and passes the driver as 1,024 maps of 4 KB.
    """
    place = F.pmod(F.xxhash64("k1", "k2"), F.lit(FILTER_BITS)).alias("place")
    chosen = cut(chosen)
    spots = chosen.select(F.bitmap_bucket_number(place + 1).alias("map"), F.bitmap_bit_position(place + 1).alias("bit"))
    maps = spots.groupBy("map").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    bits = np.zeros((FILTER_BITS // 32768, 4096), np.uint8)
    for row in maps:
        bits[row["map"] - 1] = np.frombuffer(row["bits"], np.uint8)
    shared = texts.sparkSession.sparkContext.broadcast(bits.ravel())
    grams = texts.select("k1", "k2", "text", place).mapInArrow(_sets(words, shared), "k1 long, k2 long, grams binary")
    grams = grams.groupBy("k1", "k2").agg(F.first("grams").alias("grams"))
    sets = cut(chosen.join(grams, ["k1", "k2"]).select("node", "n", "sketch", "grams"))
    drop(chosen)
    return sets


def _active(nodes: DataFrame) -> DataFrame:
    """The nodes that share a bucket with another, as a scratch table. A node is looked up in further bands only as
    long as it shares none, so that those of a hot bucket are few in the later steps."""
    found: list[DataFrame] = []
    rest = nodes
    for bands in STEPS:
        # A table of its own, so that a hot bucket can be split in the join.
        sizes = cut(few(_buckets(nodes, bands).groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")))
        some = cut(few(_buckets(rest, bands).join(sizes, "bucket", "left_semi").select("node").distinct()))
        drop(sizes)
        found.append(some)
        rest = rest.join(some, "node", "left_anti")
    active = cut(reduce(DataFrame.union, found))
    drop(*found)
    return active


def _labelled(light: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return light.withColumn("label", F.col("node"))
    return light.join(labels.select("node", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))


def _joined(links: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The components of the labels and of new links; both tables are used up."""
    if labels is not None and links.isEmpty():
        drop(links)
        return labels
    new = components(links if labels is None else _with_labels(links, labels))
    drop(links, labels)
    return new


def _with_labels(links: DataFrame, labels: DataFrame) -> DataFrame:
    """New links, and one from each node to the label that stands for the links before."""
    return links.union(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))


def _buckets(nodes: DataFrame, bands: range) -> DataFrame:
    """Each node of (node, sketch, perhaps label) in the bucket of each of its `bands`."""
    kept = [c for c in ("node", "label") if c in nodes.columns]
    columns = ", ".join(f"{c} binary" for c in kept)
    return nodes.select(*kept, "sketch").mapInArrow(_bands(kept, bands), f"{columns}, bucket long, odd boolean")


def _stars(labelled: DataFrame, bands: range, percent: int) -> DataFrame:
    """Likely pairs of a bucket's pivot, a node of its largest component, and its nodes of other components."""
    buckets = _buckets(labelled, bands)
    # Two orders of nodes, one for half of the bands: the first node of a component is its pivot.
    first = F.min(F.struct(F.xxhash64("node", "odd").alias("turn"), "node"))["node"].alias("node")
    parts = buckets.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"), first)
    heads = parts.groupBy("bucket").agg(F.max(F.struct("n", "label", "node")).alias("head"), F.count(F.lit(1)).alias("labels"))
    heads = heads.filter("labels > 1").select("bucket", F.col("head.node").alias("pivot"), F.col("head.label").alias("known"))
    heads = cut(few(heads))  # a table of its own, so that a hot bucket can be split in the join
    stars = buckets.join(heads.withColumnRenamed("bucket", "of"), (F.col("bucket") == F.col("of")) & (F.col("label") != F.col("known")))
    stars = stars.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    return stars.join(_side(labelled, "a"), "a").join(_side(labelled, "b"), "b").mapInArrow(_likely(percent), "a binary, b binary")


def _side(light: DataFrame, end: str) -> DataFrame:
    return light.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("sketch").alias(f"sketch_{end}"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a = sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a"))
    b = sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(_similar(percent), "a binary, b binary")


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets may be similar enough, told from 16 bits of each hash: most pairs that are left for
    the last step are not, and this moves a quarter of what full sets would."""
    short = sets.select("node", "grams").mapInArrow(_shortened, "node binary, n long, short binary")
    a = short.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("short").alias("short_a"))
    b = short.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("short").alias("short_b"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(_may_be_similar(percent), "a binary, b binary")


def _blocks(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components of large buckets: the nodes outside the largest component (`apart` of them) against
    all (`size`), block by block."""
    height, width = F.ceil(F.col("apart") / BLOCK).cast("int"), F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.xxhash64("node", "bucket")
    left = rows.filter(F.col("label") != F.col("main")).select(
        "bucket", "node", "label", F.pmod(own, height).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), width - 1)).alias("j"), F.lit(True).alias("left")
    )
    right = rows.select(
        "bucket", "node", "label", F.explode(F.sequence(F.lit(0), height - 1)).alias("i"), F.pmod(own, width).cast("int").alias("j"), F.lit(False).alias("left")
    )
    cells = left.union(right).join(sets.select("node", "grams"), "node")
    cells = cells.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return cells.mapInArrow(_block_links(percent), "a binary, b binary")


class Shingles:
    """Hashes of the different shingles of many texts at once, in order of text and hash."""

    def __init__(self, words: int) -> None:
        self.words, self.rolling = words, Rolling(31)
        self.odd = np.random.default_rng(32).integers(0, 2**63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The hashes, and where those of each text begin (one more entry than texts)."""
        data, at = flat(column)
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        solid = ~WHITE[data]
        other = row[1:] != row[:-1]
        starts = np.flatnonzero(solid & np.concatenate([[True], other | ~solid[:-1]])[: len(data)])
        ends = np.flatnonzero(solid & np.concatenate([other | ~solid[1:], [True]])[: len(data)]) + 1
        word = self.rolling.between(self.rolling.prefix(TO_LOWER[data]), starts, ends)
        own = row[starts]
        total = np.bincount(own, minlength=len(at) - 1)
        first = np.concatenate([[0], np.cumsum(total)])
        n = max(0, len(word) - self.words + 1)
        hashes = sum((word[j : j + n] * self.odd[j] for j in range(self.words)), np.zeros(n, np.uint64))
        inside = own[:n] == own[self.words - 1 : self.words - 1 + n]
        parts, texts = [mix(hashes[inside])], [own[:n][inside]]
        for few in range(1, self.words):
            short = np.flatnonzero(total == few)
            hashes = np.full(len(short), few, np.uint64)
            for j in range(few):
                hashes = hashes + word[first[short] + j] * self.odd[j]
            parts.append(mix(hashes))
            texts.append(short)
        hashes, texts = np.concatenate(parts), np.concatenate(texts)
        order = np.lexsort((hashes, texts))
        hashes, texts = hashes[order], texts[order]
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])])[: len(hashes)]
        hashes, texts = hashes[new], texts[new]
        return hashes, np.searchsorted(texts, np.arange(len(at)))


FACTORS = np.random.default_rng(33).integers(0, 2**31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def set_sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of a set that is not empty. Registers of a union are the maxima of the registers of its parts."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 2**32 - 1, np.uint32)
    for start in range(0, len(short), 1024):
        np.minimum(least, (short[start : start + 1024, None] * FACTORS).min(axis=0), out=least)
    exponential = -np.log1p(-(least + 0.5) / 2**32)
    return np.clip(np.floor(1 - np.log(exponential / RATE) / np.log(BASE)), 0, 2**16 - 1).astype(np.uint16)


def likeliest(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity of greatest joint likelihood for rows of registers of two sets, given the sizes of the sets."""
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    u, v = (n_a / (n_a + n_b))[:, None], (n_b / (n_a + n_b))[:, None]
    grid = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)

    def share(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    p, q = share(u - v * grid), share(v - u * grid)
    likelihood = sum(
        np.where(k > 0, k * np.log(np.maximum(chance, 1e-12)), 0.0) for k, chance in ((more, p), (less, q), (same, 1 - p - q))
    )
    return np.take_along_axis(grid, likelihood.argmax(axis=1)[:, None], 1)[:, 0]


def _keep(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    wanted = percent / 100
    fits = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return fits & (likeliest(a, b, n_a, n_b) >= wanted - DOUBT * np.sqrt(wanted * (1 - wanted) / REGISTERS))


def _sketches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            for piece in slices(batch, "text"):
                hashes, at = shingles(piece.column("text"))
                each = [hashes[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(c) for c in ("id", "k1", "k2")),
                        pa.array(np.diff(at).astype(np.int64)),
                        pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in each], pa.binary()),
                        pa.array([set_sketch(x).tobytes() if len(x) else None for x in each], pa.binary()),
                    ],
                    ["id", "k1", "k2", "n", "node", "sketch"],
                )

    return run


def _bands(kept: list[str], bands: range):
    odd = np.random.default_rng(34).integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    which = np.arange(bands.start, bands.stop)
    part = slice(bands.start * BAND, bands.stop * BAND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            registers = _registers(batch.column("sketch"))[:, part].astype(np.uint64) * odd[part]
            keys = registers.reshape(n, len(which), BAND).sum(axis=2, dtype=np.uint64)
            keys = mix(keys + which.astype(np.uint64) * odd[which])
            again = pa.array(np.repeat(np.arange(n), len(which)))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(again) for c in kept),
                    pa.array(keys.ravel().view(np.int64)),
                    pa.array(np.tile(which % 2 == 1, n)),
                ],
                [*kept, "bucket", "odd"],
            )

    return run


def _sets(words: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, bits = Shingles(words), shared.value
        for batch in batches:
            place = batch.column("place").to_numpy()
            wanted = batch.filter(pa.array((bits[place >> 3] >> (place & 7)) & 1 == 1))
            for piece in slices(wanted, "text"):
                hashes, at = shingles(piece.column("text"))
                grams = [hashes[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column("k1"), piece.column("k2"), pa.array(grams, pa.binary())], ["k1", "k2", "grams"])

    return run


def _registers(column: pa.Array) -> np.ndarray:
    return flat(column)[0].view(np.uint16).reshape(len(column), REGISTERS) if len(column) else np.zeros((0, REGISTERS), np.uint16)


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(flat(batch.column(f"sketch_{e}"))[0].tobytes(), np.uint16).reshape(-1, REGISTERS) for e in "ab")
            n_a, n_b = (batch.column(f"n_{e}").to_numpy() for e in "ab")
            yield batch.select(["a", "b"]).filter(pa.array(_keep(a, b, n_a, n_b, percent)))

    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("grams_a"), batch.column("grams_b"), strict=True):
                a, b = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                common = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of the sets, and the different first 16 bits of their hashes."""
    for batch in batches:
        sets = [np.frombuffer(x, np.uint64) for x in batch.column("grams").to_pylist()]
        short = [np.unique((x >> np.uint64(48)).astype(np.uint16)).tobytes() for x in sets]
        columns = [batch.column("node"), pa.array([len(x) for x in sets], pa.int64()), pa.array(short, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["node", "n", "short"])


def _may_be_similar(percent: int):
    """What two sets share has its short hashes among the shared ones, and of these a set holds no more hashes than
    there are, and as many as it has lost by shortening. So no pair that is similar enough is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = (batch.column(c).to_pylist() for c in ("short_a", "n_a", "short_b", "n_b"))
            for a, n_a, b, n_b in zip(*columns, strict=True):
                a, b = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)
                shared = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
                most = min(shared + min(n_a - len(a), n_b - len(b)), n_a, n_b)
                keep.append(100 * most >= percent * (n_a + n_b - most))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, also over the ends of batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        start = 0
        for i, value in enumerate(values):
            if value != last:
                if start < i:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, value
        if start < len(values):
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _across(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["bucket"]):
            node, label = group.column("node").to_pylist(), group.column("label").to_pylist()
            number = {x: i for i, x in enumerate(label)}
            part = np.array([number[x] for x in label])
            i, j = np.nonzero(np.triu(part[:, None] != part[None, :]))
            registers = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            n = group.column("n").to_numpy()
            keep = _keep(registers[i], registers[j], n[i], n[j], percent) if len(i) else np.zeros(0, bool)
            yield _pairs([(node[x], node[y]) for x, y in zip(i[keep], j[keep], strict=True)])

    return run


def _block_links(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["bucket", "i", "j"]):
            left = group.column("left").to_numpy()
            node, label = group.column("node").to_pylist(), group.column("label").to_pylist()
            sets = [np.frombuffer(x, np.uint64) for x in group.column("grams").to_pylist()]
            sizes = np.array([len(x) for x in sets])
            _, gram = np.unique(np.concatenate(sets), return_inverse=True)
            row = np.repeat(np.arange(len(sets)), sizes)
            l_rows, r_rows = np.flatnonzero(left), np.flatnonzero(~left)
            common = np.zeros((len(l_rows), len(r_rows)), np.float32)
            place = np.empty(len(sets), np.int64)
            place[l_rows], place[r_rows] = np.arange(len(l_rows)), np.arange(len(r_rows))
            for start in range(0, int(gram.max()) + 1, 4096):  # some thousand shingles at once
                here = (gram >= start) & (gram < start + 4096)
                held = [np.zeros((len(r), 4096), np.float32) for r in (l_rows, r_rows)]
                for side, which in zip(held, (left, ~left), strict=True):
                    mine = here & which[row]
                    side[place[row[mine]], gram[mine] - start] = 1
                common += held[0] @ held[1].T
            union = sizes[l_rows][:, None] + sizes[r_rows][None, :] - common
            i, j = np.nonzero(100 * common >= percent * union)
            found = [(node[l_rows[x]], node[r_rows[y]]) for x, y in zip(i, j, strict=True) if label[l_rows[x]] != label[r_rows[y]]]
            yield _pairs(found)

    return run


def _pairs(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    ends = [[min(p) for p in found], [max(p) for p in found]]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in ends], ["a", "b"])
