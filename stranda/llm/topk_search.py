"""Exact top-k search by inner product over an impact-ordered index that is read a score at a time.

Components become integers, ``floor(256 * x)``: the impacts. Vectors are dealt into blocks of bounded size. A block's index
holds its postings (row, impact) in segments, one for each dimension and quantised impact (bands of 16 impacts, by size);
segments lie in descending quantised impact. A search adds segment after segment to the accumulators of all rows of the
block. After a band, a row's missing part is at most ``|query| * |what the row has in the bands left|`` (Cauchy-Schwarz).
A row whose accumulator and bound stay under the k-th best score known exactly can no longer be among the best: the
search stops when the rows for which that is not proven are so few that scoring them exactly costs less than the bands
left. So a stop never drops a row that could be in the result; every row left is scored from its whole vector.

Blocks and queries meet in cells: a cell is one group of blocks and one group of queries, both of bounded size, and is
one group of a co-grouped join. Each cell returns the k best of each of its queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import make_importable
from .common import materialize

TOP = 5
SCALE = 256
#: Vectors of a block, blocks and queries of a cell at most, and queries that share accumulators.
BLOCK_ROWS, CELL_BLOCKS, CELL_QUERIES, TILE = 4096, 16, 4096, 256
#: Impacts of one quantised impact.
BAND = 16
#: Integers from this size on are left out, since scores of such vectors need not be exact in double.
MOST_IMPACT = 1 << 20
#: Shares of a block's postings at which a search looks for proof that it may stop.
LOOKS = (0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
#: Work to score one row exactly, in units of one posting added.
EXACT_COST = 2.5

INDEX = (
    "block int, n_rows int, width int, ids binary, copies binary, vectors binary, rows binary, impacts binary, dims binary, starts binary, bands binary, left_norms binary"
)


def impacts(vector: Column, scale: int = SCALE) -> Column:
    """The integers of a vector; null where it is null or empty, or holds a component that is null, not finite or too large."""
    wide = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) * scale >= MOST_IMPACT))
    return F.when((F.size(vector) > 0) & ~odd, F.transform(wide, lambda x: x.cast("int")))


def build_block(block: int, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> dict:
    """The index row of one block: segments of postings by descending band, then dimension, and by band the norms of what is left.

    ``left_norms[j]`` has for each row the length of what it holds in bands below the j-th, rounded up.
    """
    n, width = vectors.shape
    size = np.abs(vectors)
    band = size // BAND
    order = np.lexsort((np.tile(np.arange(width), n), -band.reshape(-1)))
    order = order[vectors.reshape(-1)[order] != 0]
    rows, dims, of_band = order // width, order % width, band.reshape(-1)[order]
    edge = np.flatnonzero(np.diff(of_band, prepend=-1).astype(bool) | np.diff(dims, prepend=-1).astype(bool))
    bands = np.unique(of_band)[::-1]
    squares = size.astype(np.float64) ** 2
    left = [np.sqrt(np.where(band < b, squares, 0).sum(axis=1)) for b in bands]
    return {
        "block": block, "n_rows": n, "width": width, "ids": ids.astype(np.int64).tobytes(), "copies": copies.astype(np.int32).tobytes(),
        "vectors": vectors.astype(np.int32).tobytes(), "rows": rows.astype(np.uint16).tobytes(), "impacts": vectors.reshape(-1)[order].astype(np.int32).tobytes(),
        "dims": dims[edge].astype(np.int32).tobytes(), "starts": np.append(edge, len(order)).astype(np.int64).tobytes(),
        "bands": of_band[edge].astype(np.int32).tobytes(), "left_norms": np.nextafter(np.array(left, np.float64).reshape(len(bands), n), np.inf).tobytes(),
    }


class Block:
    """One block's index, as arrays over the bytes of its row."""

    def __init__(self, row: dict):
        n, width = row["n_rows"], row["width"]
        of = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, self.copies, self.vectors = of("ids", np.int64), of("copies", np.int32), of("vectors", np.int32).reshape(n, width)
        self.rows, self.impacts, self.dims, self.starts, self.bands = of("rows", np.uint16), of("impacts", np.int32), of("dims", np.int32), of("starts", np.int64), of("bands", np.int32)
        self.left = of("left_norms", np.float64).reshape(-1, n)
        self.largest = int(np.abs(self.vectors).max(initial=0))


class Best:
    """The k best (score, id) of each of some queries so far, with copies counted; ``floor`` is the k-th score, or -inf."""

    def __init__(self, n: int, k: int):
        self.k, self.floor = k, np.full(n, -np.inf)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 3 for _ in range(n)]

    def take(self, q: int, scores: np.ndarray, ids: np.ndarray, copies: np.ndarray) -> None:
        s, i, c = (np.concatenate((a, b)) for a, b in zip(self.found[q], (scores, ids, copies), strict=True))
        order = np.lexsort((i, -s))
        reach = np.cumsum(c[order])
        last = int(np.searchsorted(reach, self.k)) + 1
        kept = order[:last]
        self.found[q] = s[kept], i[kept], c[kept]
        if len(reach) and reach[-1] >= self.k:
            self.floor[q] = s[kept[-1]]


def search_block(block: Block, ids: np.ndarray, queries: np.ndarray, best: Best, k: int) -> float:
    """Add to ``best`` what the block holds for ``queries``; returns the share of postings that was read."""
    n, total = len(block.ids), len(block.rows)
    bound = float(block.largest) * float(np.abs(queries).max(initial=0)) * queries.shape[1]
    kind = np.float32 if bound < 1 << 24 else np.float64  # sums of integers are exact in either
    weights = np.ascontiguousarray(queries.T).astype(kind)
    lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    scores = np.zeros((n, len(queries)), kind)
    own = block.ids[:, None] == ids[None, :]
    scores[own] = -np.inf
    exact = lambda r, q: np.einsum("ij,ij->i", block.vectors[r].astype(np.int64), queries[q].astype(np.int64))
    floor = best.floor.copy()
    looks = [x for x in LOOKS]
    first_look, read, possible = True, 0, None
    band_ends = np.flatnonzero(np.diff(block.bands, append=-1))
    segment = 0
    for j, end in enumerate(band_ends):
        for segment in range(segment, end + 1):
            a, b = block.starts[segment], block.starts[segment + 1]
            scores[block.rows[a:b]] += block.impacts[a:b, None].astype(kind) * weights[block.dims[segment]]
        segment = end + 1
        read = int(block.starts[end + 1])
        if read == total:
            break
        if not looks or read < looks[0] * total:
            continue
        looks = [x for x in looks if read < x * total]
        if first_look:
            # the rows that lead now, scored exactly, give a k-th best score that holds for all
            first_look = False
            lead = np.argpartition(-scores.T, min(k, n) - 1, axis=1)[:, :k] if n > k else np.tile(np.arange(n), (len(queries), 1))
            q = np.repeat(np.arange(len(queries)), lead.shape[1])
            sure = np.where(own[lead.reshape(-1), q], -np.inf, exact(lead.reshape(-1), q)).reshape(lead.shape)
            if lead.shape[1] >= k:
                floor = np.maximum(floor, sure.min(axis=1))
        reach = (np.ceil(block.left[j][:, None] * lengths) + 1).astype(np.float64)
        reach += scores
        open_pairs = reach >= floor
        if np.count_nonzero(open_pairs) * queries.shape[1] * EXACT_COST <= n * len(queries) * queries.shape[1] * (1 - read / total):
            possible = open_pairs & ~own
            break
    if possible is None:  # all postings were read: the accumulators are the scores
        if n > k:
            floor = np.maximum(floor, np.partition(scores, n - k, axis=0)[n - k])
        possible = (scores >= floor) & ~own
        value = lambda r, q: scores[r, q].astype(np.int64)
    else:
        value = exact
    r, q = np.nonzero(possible)
    step = 1 << 18
    got = np.concatenate([value(r[x : x + step], q[x : x + step]) for x in range(0, len(r), step)]) if len(r) else np.zeros(0, np.int64)
    good = got >= floor[q]
    r, q, got = r[good], q[good], got[good]
    by = np.argsort(q, kind="stable")
    for part in np.split(by, np.flatnonzero(np.diff(q[by])) + 1) if len(by) else ():
        best.take(int(q[part[0]]), got[part], block.ids[r[part]], block.copies[r[part]].astype(np.int64))
    return read / total if total else 1.0


def build_index(rows: DataFrame, blocks: int) -> DataFrame:
    """The index of ``rows`` (vec_id, v, copies): a row for each block and vector length. Blocks are dealt by the hash of a row."""
    width = F.size("v")
    placed = rows.select("vec_id", "v", "copies", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int").alias("block"), width.alias("width"))
    schema = pa.schema([(n, {"int": pa.int32(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in INDEX.split(", "))])

    def build(table: pa.Table) -> pa.Table:
        n, block, size = table.num_rows, table.column("block")[0].as_py(), table.column("width")[0].as_py()
        vectors = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, size)
        parts = [slice(a, a + BLOCK_ROWS * 8) for a in range(0, n, BLOCK_ROWS * 8)]  # a row number has 16 bits
        ids, copies = table.column("vec_id").to_numpy(), table.column("copies").to_numpy()
        return pa.Table.from_pylist([build_block(block, ids[p], copies[p], vectors[p]) for p in parts], schema)

    return placed.groupBy("block", "width").applyInArrow(build, INDEX)


def top_k(vectors: DataFrame, queries: Column, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of ``vectors`` (vec_id, embedding) for each row for which ``queries`` holds.

    The score is the integer inner product. Ties go to the smaller vec_id. A query meets every row but those of its
    own vec_id. Rows without a vec_id or with a vector that ``impacts`` rejects take no part; vectors of different
    lengths do not meet. A row that occurs several times fills as many ranks; a query that does is answered once. Rows of one
    vec_id with different vectors are queries of their own, and so have a rank 1 each. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    make_importable(spark)
    whole = vectors.withColumn("_asked", F.coalesce(queries, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), impacts(F.col("embedding"), scale).alias("v"), "_asked"
    )
    # equal rows fall together here, so that no row is a hot key below
    rows = whole.filter("vec_id is not null and v is not null").groupBy("vec_id", "v").agg(
        F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"), F.max("_asked").alias("asked")
    )
    rows = materialize(rows, "impact-rows")
    n, asked = rows.agg(F.count("*"), F.count_if("asked")).head()
    blocks, shares = max(1, -(-n // BLOCK_ROWS)), max(1, -(-asked // CELL_QUERIES))
    per = max(1, min(CELL_BLOCKS, blocks * shares // (2 * spark.sparkContext.defaultParallelism)))
    groups = -(-blocks // per)
    index = materialize(build_index(rows, blocks), "impact-index")
    share = F.pmod(F.xxhash64("vec_id", "v"), F.lit(shares)).cast("int")
    held = index.withColumn("group", F.floor(F.col("block") / per).cast("int")).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    sent = rows.filter("asked").select(
        "vec_id", "v", F.size("v").alias("width"), share.alias("share"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    )

    out = pa.schema([("query_id", pa.int64()), ("query", pa.list_(pa.int32())), ("vec_id", pa.int64()), ("score", pa.int64()), ("copies", pa.int64())])

    def search(left: pa.Table, right: pa.Table) -> Iterator[pa.Table]:
        if not left.num_rows or not right.num_rows:
            yield out.empty_table()
            return
        ids = right.column("vec_id").to_numpy()
        asks = right.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        held = [Block(row) for row in left.to_pylist()]
        for first in range(0, len(ids), TILE):
            tile_ids, tile = ids[first : first + TILE], asks[first : first + TILE]
            best = Best(len(tile_ids), k)
            for block in held:
                search_block(block, tile_ids, tile, best, k)
            sizes = [len(f[0]) for f in best.found]
            of = np.repeat(np.arange(len(tile_ids)), sizes)
            s, i, c = (np.concatenate(x) for x in zip(*best.found, strict=True))
            yield pa.Table.from_arrays([pa.array(tile_ids[of]), pa.array(list(tile[of]), pa.list_(pa.int32())), pa.array(i), pa.array(s), pa.array(c)], schema=out)

    keys = ["group", "share", "width"]
    found = held.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(
        lambda a, b: pa.concat_tables(search(a, b)), "query_id long, query array<int>, vec_id long, score long, copies long"
    )
    order = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id", "copy")
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    ranked = each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search_embeddings(vectors: DataFrame) -> DataFrame:
    """``top_k`` for every row whose vec_id is divisible by 50."""
    return top_k(vectors, F.col("vec_id") % 50 == 0)


SEARCH_SQL = """with whole as (select vec_id, embedding from embeddings where vec_id is not null and len(embedding) > 0
   and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
 v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from whole),
 scored as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0),
 ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
 select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5"""
