"""Exact n-gram Jaccard join in metric space (operator 10).

Jaccard distance is a metric, so a document within EPS of x is, by the triangle inequality, no more than 2 EPS farther
from x's nearest pivot than from its own.  Distances to most pivots are 1, since most documents share no
shingle; only an inverted index finds the others at this scale.  So the first regions come from it:

1. Shingle counts over all documents order the shingles from rare to frequent.  Any fixed order is exact; the rarer first, the
   smaller the regions.  Of the counts only the COMMON most frequent ones are broadcast, the rest are
   ordered by hash.
2. Two documents with similarity >= SIMILARITY share a shingle among the first |A| - ceil(SIMILARITY |A|) + 1 of each.  The
   documents that share one form a region around a pivot, the smallest of them; equal sets are one member.  A shingle
   known to be very frequent has a region of its own.
3. In a region's task the join recurses: a few pivots make Voronoi cells, the window of 2 EPS copies boundary documents
   into further cells, and cells are joined recursively down to small ones, whose pairs are measured.  Pairs that links
   already connect are not measured again.  Every measured similarity is exact, from whole sets.
4. A region too heavy for a task is cut into blocks, and pivots sent to all blocks.  What links with pivots into the
   region's largest group needs no further comparison among itself; the remaining members are joined with every block.
5. Links are closed to components.

Edge cases: null, empty and blank texts have no shingles, link with nothing, and are their own component; fewer than five words are one
shingle, the whole sequence; repeated rows and texts are one member, whose id is the smallest doc_id; a null doc_id
is larger than any other, and the component of null ids alone is null; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskhouse.llm import common
from riskhouse.llm.components import components

SIMILARITY = 80  # per cent
EPS = 0.2
#: Most frequent shingles whose counts are broadcast at most; from which count a shingle has its own region.
COMMON, HOT = 500_000, 20_000
#: Shingles of a region that one task joins at most; pivots and the size of a cell that is not cut further.
WEIGHT, PIVOTS, CELL = 1_500_000, 8, 48
#: Members of a shingle's list up to which all of them are held against each other by size and place.
NEAR = 24


# --- sets -------------------------------------------------------------------------


def set_id(s: np.ndarray) -> int:
    """64-bit hash of a sorted set of shingles."""
    if not len(s):
        return 0
    parts = np.stack([np.bitwise_xor.reduce(common.finish(s), keepdims=True), np.sum(s, keepdims=True) * np.uint64(3), np.array([len(s)], np.uint64)])
    return int(common.finish(parts.sum(axis=0, dtype=np.uint64)).view(np.int64)[0])


def _sets(batch, column: str):
    data, off = common.utf8(batch.column(column))
    return common.shingle_sets(data, off)


def prefix_size(n: int) -> int:
    return n - -(-SIMILARITY * n // 100) + 1


def members(docs: DataFrame) -> DataFrame:
    """(doc_id, t, n, sid) of every row of docs (doc_id, text, t): set size and set hash."""

    def run(batches):
        for batch in batches:
            sets = [(len(s), set_id(s)) for s in _sets(batch, "text")]
            n, sid = np.array(sets, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("t"), pa.array(n), pa.array(sid)], names=["doc_id", "t", "n", "sid"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(docs, run, f"doc_id {kind}, t long, n long, sid long")


# --- the order of shingles --------------------------------------------------------


def _deal(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by bucket, and where each bucket begins."""
    b = keys % np.uint64(buckets)
    order = np.argsort(b, kind="stable")
    return order, np.searchsorted(b[order], np.arange(buckets + 1, dtype=np.uint64))


def _code(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """What counts tell shingles apart by: the bucket and 24 bits.  The rare clash only changes the order."""
    return (tokens % np.uint64(buckets) << np.uint64(24)) | (tokens >> np.uint64(40))


def common_shingles(docs: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes, sorted, and counts of the most frequent shingles: COMMON of them at most, by counts over all documents."""

    def send(batches):
        for batch in batches:
            data, off = common.utf8(batch.column("text"))
            for lo, hi in common.row_blocks(off):
                tokens = np.concatenate([np.zeros(0, np.uint64), *common.shingle_sets(data, off[lo : hi + 1])])
                order, cut = _deal(tokens, buckets)
                high, out = (tokens[order] >> np.uint64(40)).astype("<u4"), []
                for k in range(buckets):
                    # one occurrence of a shingle as 3 bytes, several as 8 bytes with their number
                    keys, n = np.unique(high[cut[k] : cut[k + 1]], return_counts=True)
                    if len(keys):
                        many = n > 1
                        once = keys[~many].view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
                        out.append((k, once, np.stack([keys[many], n[many].astype("<u4")], axis=1).tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], schema=pa.schema([("bucket", pa.int32()), ("once", pa.binary()), ("many", pa.binary())]))

    def add(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for k, once, many in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(k, []).append((once, many))
        for k, blobs in held.items():
            keys, counts = [], []
            for once, many in blobs:
                x = np.frombuffer(once, np.uint8).reshape(-1, 3).astype("<u4")
                keys.append(x[:, 0] | x[:, 1] << 8 | x[:, 2] << 16)
                m = np.frombuffer(many, "<u4").reshape(-1, 2)
                keys.append(m[:, 0])
                counts += [np.ones(len(x), np.int64), m[:, 1].astype(np.int64)]
            key, n = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            total = np.add.reduceat(n, first) if len(key) else n
            often = total >= 8
            codes = (np.int64(k) << 24) | key[first][often].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(total[often])], names=["code", "df"])

    sent = common.map_arrow(docs.select("text"), send, "bucket int, once binary, many binary")
    counted = common.shared_checkpoint(common.map_arrow(sent.repartition(buckets, "bucket"), add, "code long, df long"))
    # the largest counts that are no more than COMMON shingles, by powers of two
    by_size = counted.groupBy(F.floor(F.log2("df")).alias("p")).count().collect()
    least, room = 64, COMMON
    for p, n in sorted(((r["p"], r["count"]) for r in by_size), reverse=True):
        room -= n
        if room < 0:
            break
        least = p
    held = counted.where(F.col("df") >= 2.0**least).toPandas().sort_values("code")
    return held["code"].to_numpy(np.uint64), held["df"].to_numpy(np.int64)


# --- regions ----------------------------------------------------------------------


def regions(docs: DataFrame, codes: np.ndarray, counts: np.ndarray, buckets: int) -> DataFrame:
    """(region, sid, n), distinct: the members of every region with two members or more."""
    shared = docs.sparkSession.sparkContext.broadcast((codes, counts))

    def send(batches):
        codes, counts = shared.value
        for batch in batches:
            data, off = common.utf8(batch.column("text"))
            for lo, hi in common.row_blocks(off):
                tokens, places, sids, sizes, hot, seen = [], [], [], [], [], set()
                for s in common.shingle_sets(data, off[lo : hi + 1]):
                    if not len(s) or (sid := set_id(s)) in seen:
                        continue
                    seen.add(sid)
                    code = _code(s, buckets)
                    at = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
                    df = np.where(codes[at] == code, counts[at], 0) if len(codes) else np.zeros(len(s), np.int64)
                    pick = np.lexsort((s, df))[: prefix_size(len(s))]
                    tokens.append(s[pick])
                    places.append(np.arange(len(pick), dtype="<u4"))
                    hot.append(df[pick] >= HOT)
                    sids.append(sid)
                    sizes.append(len(s))
                if not tokens:
                    continue
                k = [len(t) for t in tokens]
                token, sid, n = np.concatenate(tokens), np.repeat(np.array(sids, np.int64), k), np.repeat(np.array(sizes, "<u4"), k)
                often, place = np.concatenate(hot), np.concatenate(places)
                # a hot shingle's rows are spread over the buckets by member
                order, cut = _deal(np.where(often, sid.view(np.uint64), token), buckets)
                out = [(b, token[o].tobytes(), sid[o].tobytes(), n[o].tobytes(), place[o].tobytes(), often[o].tobytes()) for b in range(buckets) if len(o := order[cut[b] : cut[b + 1]])]
                names = ["bucket", "token", "sid", "n", "place", "often"]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], schema=pa.schema([(c, pa.binary() if c != "bucket" else pa.int32()) for c in names]))

    def gather(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for k, *blobs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(k, []).append(blobs)
        found = []
        for blobs in held.values():
            kinds = (np.uint64, np.int64, "<u4", "<u4", bool)
            token, sid, n, place, often = (np.concatenate([np.frombuffer(b[j], kind) for b in blobs]) for j, kind in enumerate(kinds))
            found.append(np.stack([token[often].view(np.int64), sid[often], n[often].astype(np.int64)], axis=1))
            kept = _partners(token[~often], sid[~often], n[~often].astype(np.int64), place[~often].astype(np.int64))
            if len(kept):
                found.append(kept)
        if found:
            rows = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=["region", "sid", "n"])

    sent = common.map_arrow(docs.select("text"), send, "bucket int, token binary, sid binary, n binary, place binary, often binary")
    out = common.map_arrow(sent.repartition(buckets, "bucket"), gather, "region long, sid long, n long")
    return out.distinct()


def _groups(token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted tokens: where each begins, the group of each row, and the groups' sizes."""
    new = np.append(True, token[1:] != token[:-1])[: len(token)]
    first = np.flatnonzero(new)
    return first, np.cumsum(new) - 1, np.diff(np.append(first, len(token)))


def _partners(token: np.ndarray, sid: np.ndarray, n: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Rows (pivot, sid, n) of the shingles' lists, pivot the list's smallest sid.

    A member stays only if it can have a partner in the list: if a shingle is the first
    that two members share, they share at most what follows it in either, which with their sizes
    has to leave the similarity.  The lists are in order of size; members of lists longer than
    NEAR stay whatever their partners are.
    """
    order = np.lexsort((sid, token))
    token, sid, n, place = token[order], sid[order], n[order], place[order]
    once = np.append(True, (token[1:] != token[:-1]) | (sid[1:] != sid[:-1]))[: len(token)]
    order = np.flatnonzero(once)
    order = order[np.lexsort((n[order], token[order]))]
    token, sid, n, place = token[order], sid[order], n[order], place[order]
    _, group, size = _groups(token)
    stays, rest = (size > NEAR)[group], n - place
    for step in range(1, min(NEAR, int(size.max(initial=1)))):
        a, b = slice(0, len(n) - step), slice(step, len(n))
        most = np.minimum(rest[a], rest[b])
        both = n[a] + n[b]
        ok = (group[a] == group[b]) & ((100 + SIMILARITY) * most >= SIMILARITY * both)
        stays[a] |= ok
        stays[b] |= ok
    token, sid, n = token[stays], sid[stays], n[stays]
    first, group, size = _groups(token)
    pivot = np.minimum.reduceat(sid, first)[group] if len(first) else sid
    many = (size > 1)[group]
    return np.stack([pivot[many], sid[many], n[many]], axis=1)


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def join_region(sets: list[np.ndarray], union: Union | None = None) -> list[tuple[int, int]]:
    """Links that connect the members of a region as all their links would, by recursive Voronoi cells."""
    union = union or Union(len(sets))
    sizes = np.array([len(s) for s in sets], np.int64)
    words, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    links: list[tuple[int, int]] = []

    def shared(p: int, others: np.ndarray) -> np.ndarray:
        """Shingles that p has in common with each of the others."""
        mark = np.zeros(len(words), bool)
        mark[codes[starts[p] : starts[p + 1]]] = True
        if len(others) == len(sizes):
            return np.add.reduceat(mark[codes], starts[:-1], dtype=np.int64)
        return np.array([np.count_nonzero(mark[codes[starts[o] : starts[o + 1]]]) for o in others], np.int64)

    def measure(p: int, others: np.ndarray) -> np.ndarray:
        """Distances; links found on the way are kept."""
        both = shared(p, others)
        either = sizes[p] + sizes[others] - both
        for o in others[100 * both >= SIMILARITY * either].tolist():
            if o != p and union.join(p, o):
                links.append((p, o))
        return 1.0 - both / either

    def every_pair(own: np.ndarray) -> None:
        own = own[np.argsort(sizes[own], kind="stable")]
        for k, p in enumerate(own.tolist()[:-1]):
            rest = own[k + 1 :]
            rest = rest[100 * sizes[p] >= SIMILARITY * sizes[rest]]
            root = union.find(p)
            rest = np.array([o for o in rest.tolist() if union.find(o) != root], np.int64)
            if len(rest):
                measure(p, rest)

    todo = [np.arange(len(sets))]
    while todo:
        own = todo.pop()
        roots = {union.find(x) for x in own.tolist()}
        if len(roots) < 2:
            continue
        if len(own) <= CELL:
            every_pair(own)
            continue
        pivots = own[np.linspace(0, len(own) - 1, PIVOTS).astype(int)]
        far = np.stack([measure(int(p), own) for p in pivots])
        nearest = far.min(axis=0)
        cells = [own[far[i] <= nearest + 2 * EPS + 1e-9] for i in range(PIVOTS)]
        cells = [c for i, c in enumerate(cells) if (far[i] <= nearest).any()]
        # cells that do not shrink are no use: their pairs are measured, but for those already connected
        if sum(map(len, cells)) > 2 * len(own):
            every_pair(own)
        else:
            todo += cells
    return links


def _join_groups(rows: DataFrame) -> DataFrame:
    """(a, b): links of the members of each region; rows (region, sid, text), each region within one task."""

    def run(batches):
        region, sids, sets = None, [], []

        def close():
            if len(sids) > 1:
                for a, b in join_region(sets):
                    yield sids[a], sids[b]

        for batch in batches:
            out = []
            keys = batch.column("region").to_pylist()
            names = batch.column("sid").to_pylist()
            for key, sid, s in zip(keys, names, _sets(batch, "text"), strict=True):
                if key != region:
                    out += close()
                    region, sids, sets = key, [], []
                if not sids or sids[-1] != sid:
                    sids.append(sid)
                    sets.append(s)
            if out:
                yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in out])
        out = [{"a": a, "b": b} for a, b in close()]
        if out:
            yield pa.RecordBatch.from_pylist(out)

    dealt = rows.repartition("region").sortWithinPartitions("region", "sid")
    return common.map_arrow(dealt, run, "a long, b long")


def _with_text(rows: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """rows (region, sid) with the text of each member's representative document."""
    wanted = rows.groupBy("sid").agg(F.collect_list("region").alias("regions")).join(reps, "sid")
    texts = docs.select(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("d"), "t", "text")  # equal rows come twice, which does no harm
    return wanted.join(texts, ["d", "t"]).select(F.explode("regions").alias("region"), "sid", "text")


def _pivot_links(rows: DataFrame) -> DataFrame:
    """(region, a, b): members a of heavy regions' blocks that link with pivot b; rows (region, block, sid, pivot, text)."""

    def run(batches):
        block, pivots = None, []
        for batch in batches:
            out = []
            cols = [batch.column(c).to_pylist() for c in ("region", "block", "sid", "pivot")]
            for region, k, sid, pivot, s in zip(*cols, _sets(batch, "text"), strict=True):
                if (region, k) != block:
                    block, pivots = (region, k), []
                for p, own in pivots:
                    both = len(np.intersect1d(s, own, assume_unique=True))
                    if p != sid and 100 * both >= SIMILARITY * (len(s) + len(own) - both):
                        out.append({"region": region, "a": sid, "b": p})
                if pivot:
                    pivots.append((sid, s))
            if out:
                yield pa.RecordBatch.from_pylist(out)

    dealt = rows.repartition("region", "block").sortWithinPartitions("region", "block", F.desc("pivot"), "sid")
    return common.map_arrow(dealt, run, "region long, a long, b long")


def _heavy(members: DataFrame, weights: DataFrame, reps: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For regions over WEIGHT: links (a, b) with their pivots, and the members of the regions that remain to be joined."""
    own = members.join(weights.where(F.col("weight") > WEIGHT), "region")
    blocks = F.ceil(F.col("weight") * 2 / WEIGHT).cast("long")
    rank = F.expr("row_number() OVER (PARTITION BY region ORDER BY xxhash64(sid, region), sid)")
    pivots = own.withColumn("k", rank).where(F.col("k") <= 2 * PIVOTS).drop("k")
    plain = own.select("region", F.pmod(F.xxhash64("sid", "region"), blocks).alias("block"), "sid", F.lit(0).alias("pivot"))
    spread = pivots.select("region", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), "sid", F.lit(1).alias("pivot"))
    placed = common.shared_checkpoint(plain.unionByName(spread))
    # the text goes once to each (region, block) that needs it
    packed = placed.select(F.struct("region", "block", "pivot").alias("region"), "sid")
    rows = _with_text(packed, reps, docs).select("region.*", "sid", "text").select("region", "block", "sid", "pivot", "text")
    links = common.shared_checkpoint(_pivot_links(rows))
    grouped = components(links)
    # members by group; those without a link to a pivot are their own
    state = own.join(grouped.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    state = common.shared_checkpoint(state.select("region", "sid", "n", "root", "weight"))
    sizes = state.groupBy("region", "root").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("region").agg(F.max(F.struct("c", "root")).alias("top")).select("region", F.col("top.root").alias("top"))
    state = state.join(largest, "region")
    left = state.where("root <> top")
    parts = left.groupBy("region").agg(F.ceil(F.sum("n") * 2 / WEIGHT).cast("long").alias("parts"))
    name = lambda a, b: F.xxhash64(F.lit("grid"), "region", a, b)
    a, b = F.pmod(F.xxhash64("sid", F.lit(1)), F.col("parts")), F.pmod(F.xxhash64("sid", "region"), blocks)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    rest = left.join(parts, "region").withColumn("x", a).withColumn("y", every(blocks)).select(name("x", "y").alias("region"), "sid", "n")
    whole = state.join(parts, "region").withColumn("y", b).withColumn("x", every(F.col("parts"))).select(name("x", "y").alias("region"), "sid", "n")
    return links.select("a", "b"), rest.unionByName(whole).distinct()


def links(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b): links between set ids, enough to connect all that are linked; docs (doc_id, text, t), reps (sid, d, t)."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    codes, counts = common_shingles(docs, buckets)
    found = common.shared_checkpoint(regions(docs, codes, counts, buckets))
    weights = found.groupBy("region").agg(F.sum("n").alias("weight"), F.count("*").alias("members")).where("members > 1")
    weights = common.shared_checkpoint(weights)
    light = found.join(weights.where(F.col("weight") <= WEIGHT), "region").select("region", "sid")
    if weights.where(F.col("weight") > WEIGHT).isEmpty():
        return _join_groups(_with_text(light, reps, docs))
    first, rest = _heavy(found, weights, reps, docs)
    return first.unionByName(_join_groups(_with_text(light.unionByName(rest.select("region", "sid")), reps, docs)))


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, t, n_shingles, root, component_id) of every row of docs; t is the text's hash, root the component's own set id.

    component_id is the smallest doc_id, so it is null or shared where ids are null or repeated; root is neither (null only without a shingle).
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("t"))
    every = common.shared_checkpoint(members(rows))
    id_ = F.coalesce("doc_id", F.lit(2**63 - 1))
    reps = every.where("n > 0").groupBy("sid").agg(F.min(F.struct(id_.alias("d"), "t")).alias("r")).select("sid", "r.d", "r.t")
    reps = common.shared_checkpoint(reps)
    grouped = common.shared_checkpoint(components(links(rows, reps)))
    named = grouped.join(reps, grouped["node"] == reps["sid"]).select("sid", "root", "d")
    least = named.groupBy("root").agg(F.min("d").alias("least"))
    named = named.join(least, "root").select("sid", "root", "least")
    class_of = reps.select("sid", "d").join(named, "sid", "left").select("sid", F.coalesce("root", "sid").alias("root"), F.coalesce("least", "d").alias("least"))
    out = every.join(class_of, "sid", "left")
    least = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "t", F.col("n").alias("n_shingles"), "root", F.when(least != 2**63 - 1, least).alias("component_id"))


def op10_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return classes(common.documents(spark, sf_dir)).drop("t", "root")


def keep_one(docs: DataFrame) -> DataFrame:
    """Pipeline stage: of each component the document with the smallest id (one of equal rows); columns as they are."""
    found = classes(docs).where("n_shingles > 0")
    id_ = F.coalesce("doc_id", F.lit(2**63 - 1))
    best = found.select(F.col("root").alias("g"), id_.alias("_d"), F.col("t").alias("_t")).groupBy("g").agg(F.min(F.struct("_d", "_t")).alias("b"))
    best = best.select("b.*").withColumn("_keep", F.lit(True))
    keyed = common.packed(docs, ["doc_id", "text"]).withColumns({"_d": F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)), "_t": F.xxhash64("text")})
    blank = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = keyed.join(best, ["_d", "_t"], "left").where(F.col("_keep") | blank)
    solid, empty = kept.where(~blank).dropDuplicates(["_d", "_t"]), kept.where(blank)
    return common.unpacked(solid.unionByName(empty), docs)
