"""N-gram Jaccard join: texts whose sets of word shingles are alike, exactly, and the groups they form.

Method. Equal sets are one class. In a fixed order of all shingles, two sets with a Jaccard index of at
least p % share one of their first n - ceil(p n / 100) + 1 shingles, so classes meet in the groups of
those leading shingles. The order puts shingles that many documents have last (counted over all
documents into a table of fixed size; any order is right, this one keeps groups small). Within a group,
classes are sorted by size and cut into tiles of bounded size; a pair of tiles is met only if the sizes
in them can be alike. In a tile, hashed bitmap signatures bound the overlap of two sets from above: each bit
that only one of them has is a shingle the other lacks. What is left is compared exactly, by
intersecting sorted arrays.

A shingle's place in the order of its set bounds the overlap as well: two sets that meet first at places
i and j lack i and j shingles of each other. A pair is compared in the group of the first shingle it
shares, so a group may leave out pairs whose places in it do not allow a link.

A large group of near copies would still make many pairs, so this runs in two rounds. The first compares
each member of a group only with its neighbour by size and with the centres of its own and the next
lower size band, the members with the fewest rare shingles: near copies fall into one component in linear
work. The second compares, in tiles, every two members that the first round has not connected. No pair
of different components is left out, so the components are those of all links.

Texts are compared by 64-bit hashes of shingles, classes by 128 bits.

Defined results: null or empty texts, and texts of white space, have no shingles, link with nothing and
are components of their own; texts of fewer words than a shingle are one shingle; documents without an
id link with nothing and have no component; rows of one id are one node of the graph; repeated rows are
counted as one node and returned each; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import U64, BitSet, components, folder_of, known_to_workers, mapped, mix, signed, texts_of, word_hashes

SHINGLE = 5
PERCENT = 80
#: Sizes of the tables and tiles; they change speed and memory, never results.
ORDER_BITS = 22
CLASS_BITS = 27
TILE = 256
LEAST_SIGNATURE = 512
#: Bytes of a bitmap that goes into tiles, where a class may be in many: wider ones are folded, and those of the pairs
#: that are left are compared in full width.
TILE_SIGNATURE = 128


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, sorted, one text after another; where each ends."""
    words, counts = word_hashes(texts)
    bounds = np.append(0, np.cumsum(counts))
    folded = np.zeros(max(0, len(words) - size + 1), U64)
    for i in range(size):
        folded = (folded + words[i : i + len(folded)]) * U64(0x9FB21C651E98DF25)
    folded = mix(folded)
    out, sizes = [], np.zeros(len(texts), np.int64)
    for i, (a, n) in enumerate(zip(bounds[:-1].tolist(), counts.tolist())):
        if not n:
            continue
        if n < size:
            whole = np.array([n], U64)
            for w in words[a : a + n]:
                whole = mix(whole * U64(0xD6E8FEB86659FD93) + w)
            found = whole
        else:
            found = np.sort(folded[a : a + n - size + 1])
            if len(found) > 1:
                found = found[np.concatenate([[True], found[1:] != found[:-1]])]
        out.append(found)
        sizes[i] = len(found)
    return (np.concatenate(out) if out else np.empty(0, U64)), np.cumsum(sizes)


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The smallest overlap k with 100 k >= percent (a + b - k)."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def signature(found: np.ndarray) -> bytes:
    """A bitmap of the hashes; about two bits for each, a power of two in all."""
    bits = max(LEAST_SIGNATURE, 1 << (2 * len(found) - 1).bit_length())
    held = np.zeros(bits, np.uint8)
    held[(mix(found) & U64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(held, bitorder="little").tobytes()


def folded(signature: bytes) -> bytes | None:
    """A wide bitmap in TILE_SIGNATURE bytes; None if it is no wider."""
    if len(signature) <= TILE_SIGNATURE:
        return None
    return np.bitwise_or.reduce(np.frombuffer(signature, U64).reshape(-1, TILE_SIGNATURE // 8), 0).tobytes()


def overlap_bounds(signatures: list[bytes], sizes: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The most that the sets of rows `one` and `two` can share, by their bitmaps (of unequal ones the larger is folded)."""
    out = np.minimum(sizes[one], sizes[two])
    widths = np.array([len(s) for s in signatures])
    least = np.minimum(widths[one], widths[two])
    for width in np.unique(least).tolist():
        at = np.flatnonzero(least == width)
        rows = np.unique(np.concatenate([one[at], two[at]]))
        held = np.zeros((len(rows), width // 8), U64)
        for i, row in enumerate(rows.tolist()):
            held[i] = np.bitwise_or.reduce(np.frombuffer(signatures[row], U64).reshape(-1, width // 8), 0)
        for part in np.array_split(at, len(at) * width // (32 << 20) + 1):
            a, b = held[np.searchsorted(rows, one[part])], held[np.searchsorted(rows, two[part])]
            lacks_b = np.bitwise_count(a & ~b).sum(1, dtype=np.int64)
            lacks_a = np.bitwise_count(b & ~a).sum(1, dtype=np.int64)
            out[part] = np.minimum(sizes[one[part]] - lacks_b, sizes[two[part]] - lacks_a)
    return out


def _commonness(rows: DataFrame, size: int) -> np.ndarray:
    """For every slot of a table of 2**ORDER_BITS, how common the shingles that fall into it are (0 to 7)."""

    def counted(part: pa.RecordBatch) -> dict:
        hashes, _ = shingle_sets(texts_of(part.column("text")), size)
        hashes.sort()
        new = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.empty(0, np.int64)
        counts = np.diff(np.append(new, len(hashes)))
        often = counts > 1
        return {"slot": (hashes[new[often]] & U64(2**ORDER_BITS - 1)).astype(np.int32), "n": counts[often]}

    found = mapped(rows, "text", counted, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    level = F.least(F.lit(7), (F.log2("n") / 2).cast("int"))
    # At most one row a slot comes to the driver.
    table = found.select("slot", level.cast("byte").alias("level")).where("level > 0").toArrow()
    out = np.zeros(2**ORDER_BITS, np.uint8)
    out[table["slot"].to_numpy()] = table["level"].to_numpy()
    return out


def described(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """doc_id, n (size of the set), c and d (hashes of the set), prefix, signature and small (folded): one row a document, written down."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    common = rows.sparkSession.sparkContext.broadcast(_commonness(rows.select("text"), size))  # 2**ORDER_BITS bytes

    def make(part: pa.RecordBatch) -> dict:
        hashes, ends = shingle_sets(texts_of(part.column("text")), size)
        out: dict[str, list] = {"n": [], "c": [], "d": [], "prefix": [], "signature": [], "small": []}
        first, second = mix(hashes + U64(1)), mix(hashes ^ U64(0x5851F42D4C957F2D))
        rank = (common.value[(hashes & U64(2**ORDER_BITS - 1)).astype(np.int64)].astype(U64) << U64(61)) | (hashes >> U64(3))
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
            found = hashes[a:b]
            n = b - a
            out["n"].append(n)
            out["c"].append(int(signed(mix(np.array([first[a:b].sum(dtype=U64) + U64(n)])))[0]))
            out["d"].append(int(signed(np.array([second[a:b].sum(dtype=U64)]))[0]))
            # The hashes are sorted, so equal ranks stay in one order everywhere.
            leading = found[np.argsort(rank[a:b], kind="stable")[: prefix_length(n, percent)]] if n else found
            out["prefix"].append(signed(leading))
            out["signature"].append(signature(found) if n else b"")
            out["small"].append(folded(out["signature"][-1]))
        return {"doc_id": part.column("doc_id"), **out}

    made = folder_of(mapped(rows, "text", make, f"doc_id {kind}, n long, c long, d long, prefix array<long>, signature binary, small binary"))
    common.unpersist()
    return made


def _grouped(batches):
    """Rows sorted by token and size: of tokens that two rows have, their rows, with the place in the group and the row before."""
    names = ["token", "c", "n", "lead", "place", "before", "n_before", "lead_before"]
    kept: list[np.ndarray] | None = None  # the last row, not yet given out
    for batch in batches:
        if not batch.num_rows:
            continue
        token, c, n, lead = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        if kept is not None:
            token, c, n, lead = (np.append(old, new) for old, new in zip(kept, (token, c, n, lead)))
        opens = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        place = np.arange(len(token)) - np.repeat(opens, np.diff(np.append(opens, len(token))))
        before, n_before, lead_before = np.roll(c, 1), np.roll(n, 1), np.roll(lead, 1)
        if kept is not None:
            place[: opens[1] if len(opens) > 1 else len(place)] += kept[4][0]
            before[0], n_before[0], lead_before[0] = (x[0] for x in kept[5:])
        after = np.append(token[1:] == token[:-1], False)
        give = (place > 0) | after
        give[-1] = False
        if give.any():
            yield _rows([x[give] for x in (token, c, n, lead, place, before, n_before, lead_before)], names)
        kept = [x[-1:] for x in (token, c, n, lead, place, before, n_before, lead_before)]
    if kept is not None and kept[4][0] > 0:
        yield _rows(kept, names)


def _rows(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=names)


def _meeting(percent: int):
    """Rows sorted by tile: pairs of unconnected classes whose sizes and bitmaps allow a link."""

    def run(batches):
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            keys = [held[k].to_numpy() for k in ("token", "low", "high")]
            last = np.flatnonzero((keys[0] == keys[0][-1]) & (keys[1] == keys[1][-1]) & (keys[2] == keys[2][-1]))[0]
            if last:  # the last tile may go on in the next batch; a tile has 2 * TILE rows at most
                yield from pairs(held.slice(0, last))
                held = held.slice(last).combine_chunks()
        if held is not None and held.num_rows:
            yield from pairs(held)

    def pairs(rows: pa.Table):
        token, low, high, c, n, lead, component, upper = (rows[k].to_numpy() for k in ("token", "low", "high", "c", "n", "lead", "component", "upper"))
        fresh = np.concatenate([[True], (token[1:] != token[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
        tile = np.cumsum(fresh)
        cross = low != high
        one, two = [], []
        for step in range(1, int(np.bincount(tile).max())):
            a = np.flatnonzero(tile[:-step] == tile[step:])
            b = a + step
            fits = (component[a] != component[b]) & (~cross[a] | (upper[a] != upper[b]))
            fits &= (100 + percent) * np.minimum(n[a] - lead[a], n[b] - lead[b]) >= percent * (n[a] + n[b])
            one.append(a[fits])
            two.append(b[fits])
        if not one:
            return
        one, two = np.concatenate(one), np.concatenate(two)
        if len(one):
            bound = overlap_bounds(rows["signature"].to_pylist(), n, one, two)
            may = bound >= least_overlap(n[one], n[two], percent)
            a, b = c[one[may]], c[two[may]]
            if len(a):
                found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return run


def _verified(pairs: DataFrame, documents: DataFrame, doc_id: str, text: str, percent: int, size: int) -> DataFrame:
    """Of the pairs (a, b) of classes those that link, by exact intersection of their sets."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("c"))
    needed = pairs.sparkSession.sparkContext.broadcast(BitSet.of(nodes, "c", CLASS_BITS))

    def texts(part: pa.RecordBatch) -> dict | None:
        held = texts_of(part.column("text"))
        hashes, ends = shingle_sets(held, size)
        sums = np.append(U64(0), np.cumsum(mix(hashes + U64(1)), dtype=U64))
        starts = np.append(0, ends[:-1])
        c = mix(sums[ends] - sums[starts] + (ends - starts).astype(U64))
        rows = np.flatnonzero(needed.value.has(c) & (ends > starts))
        return {"c": signed(c[rows]), "text": [held[i] for i in rows.tolist()]} if len(rows) else None

    rows = documents.where(F.col(doc_id).isNotNull()).select(F.col(text).alias("text"))
    held = mapped(rows, "text", texts, "c long, text binary").groupBy("c").agg(F.min("text").alias("text"))
    both = pairs.join(held.select(F.col("c").alias("a"), F.col("text").alias("t")), "a")
    both = both.join(held.select(F.col("c").alias("b"), F.col("text").alias("u")), "b")

    def linked(part: pa.RecordBatch) -> dict:
        t, u = part.column("t").to_pylist(), part.column("u").to_pylist()
        hashes, ends = shingle_sets(t + u, size)
        sets = np.split(hashes, ends[:-1])
        keep = []
        for x, y in zip(sets[: len(t)], sets[len(t) :]):
            merged = np.sort(np.concatenate([x, y]))
            shared = np.count_nonzero(merged[1:] == merged[:-1])
            keep.append((100 + percent) * shared >= percent * (len(x) + len(y)))
        at = pa.array(np.flatnonzero(keep))
        return {"a": part.column("a").take(at), "b": part.column("b").take(at)}

    made = folder_of(mapped(both, "t", linked, "a long, b long"))
    needed.unpersist()  # what used it is written down; a straggler may still fetch it
    return made


def links(rows: DataFrame, documents: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """Links (a, b) between classes that connect exactly what all links connect; `rows` are from `described`."""
    spark = rows.sparkSession
    known_to_workers(spark)
    some = rows.where("n > 0 and doc_id is not null")
    classes = some.groupBy("c", "d", "n").agg(F.min("doc_id").alias("doc_id"))
    # One document speaks for its class; should the bit set let a copy through, it says the same again.
    speakers = spark.sparkContext.broadcast(BitSet.of(classes.select(F.xxhash64("doc_id").alias("h")), "h", CLASS_BITS))

    def tokens(part: pa.RecordBatch) -> dict:
        at = pa.array(np.flatnonzero(speakers.value.has(part.column("h").to_numpy().view(U64))))
        prefix = part.column("prefix").take(at)
        counts = np.diff(prefix.offsets.to_numpy())
        leads = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return {"token": prefix.flatten(), "c": np.repeat(part.column("c").take(at).to_numpy(), counts),
                "n": np.repeat(part.column("n").take(at).to_numpy(), counts), "lead": leads}

    spread = mapped(some.select("c", "n", "prefix", F.xxhash64("doc_id").alias("h"), F.lit(b"").alias("none")), "none", tokens, "token long, c long, n int, lead int")
    spread = spread.repartition("token").sortWithinPartitions("token", "n", "c")
    layout = "token long, c long, n long, lead long, place long, before long, n_before long, lead_before long"
    groups = folder_of(spread.mapInArrow(_grouped, layout))
    speakers.unpersist()
    signatures = some.groupBy("c").agg(F.first("n").alias("n"), F.first("signature").alias("signature"), F.first("small").alias("small"))

    may_link = f"{100 + percent} * least(n - lead, n_before - lead_before) >= {percent} * (n + n_before)"
    beside = groups.where("place > 0")
    bands = groups.withColumn("band", F.floor(F.log("n") / float(np.log(100 / percent))))
    centres = bands.groupBy("token", "band").agg(F.min(F.struct("lead", "c", "n")).alias("m"))
    centres = centres.select("token", "band", F.col("m.c").alias("before"), F.col("m.n").alias("n_before"), F.col("m.lead").alias("lead_before"))
    bands = bands.select("token", "c", "n", "lead", F.explode(F.array("band", F.col("band") - 1)).alias("band"))
    near = beside.select("c", "n", "lead", "before", "n_before", "lead_before").unionByName(bands.join(centres, ["token", "band"]).drop("token", "band"))
    near = near.where("c <> before").where(may_link)
    near = near.select(F.least("c", "before").alias("a"), F.greatest("c", "before").alias("b")).distinct()
    first = _verified(_bounded(near, signatures, percent), documents, doc_id, text, percent, size)

    # Second round: tiles of members that are not connected yet. Groups of two have been compared.
    joined = components(first)
    members = groups.select("token", "c", "n", "lead", "place").join(joined.withColumnRenamed("node", "c"), "c", "left")
    members = members.withColumn("component", F.coalesce("component", "c")).withColumn("block", F.floor(F.col("place") / TILE))
    blocks = members.groupBy("token", "block").agg(
        F.min("component").alias("low_component"), F.max("component").alias("high_component"),
        F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("size"),
    )
    open_tokens = blocks.groupBy("token").agg(F.min("low_component").alias("x"), F.max("high_component").alias("y"), F.sum("size").alias("s"))
    open_tokens = open_tokens.where("x <> y and s > 2").select("token")
    blocks = blocks.join(open_tokens, "token")
    one, two = blocks.alias("one"), blocks.alias("two")
    tiles = one.join(two, "token").where(
        "one.block <= two.block and 100 * one.most >= {0} * two.least "
        "and not (one.low_component = one.high_component and two.low_component = two.high_component "
        "and one.low_component = two.low_component)".format(percent)
    ).select("token", F.col("one.block").alias("low"), F.col("two.block").alias("high"))
    ways = tiles.select("token", "low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
    met = members.join(ways, ["token", "block"]).join(signatures.select("c", F.coalesce("small", "signature").alias("signature")), "c")
    met = met.select("token", "low", "high", "c", "n", "lead", "component", (F.col("block") == F.col("high")).cast("int").alias("upper"), "signature")
    met = met.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high")
    left = met.mapInArrow(_meeting(percent), "a long, b long").distinct()
    second = _verified(_bounded(folder_of(left), signatures, percent), documents, doc_id, text, percent, size)
    return first.unionByName(second).distinct()


def _bounded(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps allow a link."""
    a = signatures.select(F.col("c").alias("a"), F.col("n").alias("m"), F.col("signature").alias("s"))
    b = signatures.select(F.col("c").alias("b"), F.col("n").alias("o"), F.col("signature").alias("t"))

    def allowed(part: pa.RecordBatch) -> dict:
        sizes = np.concatenate([part.column("m").to_numpy(), part.column("o").to_numpy()])
        k = part.num_rows
        bound = overlap_bounds(part.column("s").to_pylist() + part.column("t").to_pylist(), sizes, np.arange(k), np.arange(k, 2 * k))
        at = pa.array(np.flatnonzero(bound >= least_overlap(sizes[:k], sizes[k:], percent)))
        return {"a": part.column("a").take(at), "b": part.column("b").take(at)}

    return folder_of(mapped(pairs.join(a, "a").join(b, "b"), "s", allowed, "a long, b long"))


def joined(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id: one row for each row of `documents`."""
    rows = described(documents, doc_id, text, percent, size)
    some = rows.where("n > 0 and doc_id is not null")
    classes = some.groupBy("c", "d", "n").agg(F.min("doc_id").alias("speaker"))
    copies = some.join(classes, ["c", "d", "n"]).where("doc_id <> speaker").select(F.col("doc_id").alias("a"), F.col("speaker").alias("b"))
    names = classes.select("c", "speaker")
    found = links(rows, documents, doc_id, text, percent, size)
    found = found.join(names.select(F.col("c").alias("a"), F.col("speaker").alias("x")), "a").join(names.select(F.col("c").alias("b"), F.col("speaker").alias("y")), "b")
    edges = copies.unionByName(found.select(F.col("x").alias("a"), F.col("y").alias("b")))
    out = rows.select("doc_id", F.col("n").alias("n_shingles")).join(components(edges).withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """The documents without near copies: of each component the one with the smallest id stays (and rows without id).

    A node is an id with its text, so unlike texts of one id are told apart and both stay; of several texts of one id
    in one component the one with the smaller hash stays, and of rows equal in both the first as JSON.
    Bit sets of what goes tell most rows apart; only the others are shuffled for the joins that decide.
    """
    spark = documents.sparkSession
    parts = F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), F.col(text)).alias("i"))
    node = F.when(F.col(doc_id).isNotNull(), parts).alias("__node")
    texts = documents.select(node, F.col(text).alias("__text"))
    gone = joined(texts, "__node", "__text", percent, size).where("component_id <> doc_id").select(F.col("doc_id").alias("__node"))
    again = texts.where("__node is not null").groupBy("__node").agg(F.count("*").alias("n")).where("n > 1").select("__node")
    # Of nodes that go, no row stays; of those that several rows have, one does.
    gone = gone.distinct().withColumn("goes", F.lit(True)).unionByName(again.withColumn("goes", F.lit(False)))
    gone = folder_of(gone.groupBy("__node").agg(F.max("goes").alias("__goes")))
    held = spark.sparkContext.broadcast(BitSet.of(gone.select(F.xxhash64("__node").alias("h")), "h", CLASS_BITS))

    def told_apart(batches):
        for batch in batches:
            asked = pa.array(held.value.has(batch.column("__hash").to_numpy().view(U64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], asked], names=["__row", "__node", "__asked"])

    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("__row"), node)
    fields = T.StructType([*rows.schema.fields, T.StructField("__asked", T.BooleanType())])
    told = rows.withColumn("__hash", F.xxhash64("__node")).mapInArrow(told_apart, fields)
    asked = told.where("__asked").join(gone, "__node", "left").where("not coalesce(__goes, false)")
    several = asked.where("__goes is not null").groupBy("__node").agg(F.min_by("__row", F.to_json("__row")).alias("__row"))
    kept = [told.where("not __asked"), asked.where("__goes is null"), several]
    return kept[0].select("__row.*").unionByName(kept[1].select("__row.*")).unionByName(kept[2].select("__row.*"))
