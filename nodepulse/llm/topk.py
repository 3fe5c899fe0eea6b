"""Exact top-k by inner product: histogram selection over all scores.

Query blocks meet candidate blocks, and each meeting scores everything.  A round
counts a query's scores in bins of its present range; counts are summed over all
blocks, and the bin that holds the k-th score is the next range, until it is one
score wide.  Then every candidate above the k-th score is taken, and of those at
it the ones with the smallest ids.  A block leaves out bins below its own k-th
score, which cannot hold the k-th of all, and hands on at most k ties of its own.

Vectors are scored with those of the same number of components.  Scores are
integers; they are computed as doubles while those are exact, else as 64-bit
integers; beyond 2**61 they end in an error, not in a wrong result.

Cases: a vector that is null, empty, or holds a null or non-finite component
takes no part; a query is not its own candidate, nor is any row of its id; rows
that repeat are candidates of their own; a null id takes no part; fewer than k
candidates are all returned; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nodepulse.llm.common import kept

#: Bins of a histogram, vectors in a candidate block, queries in a query block.
BINS, CANDIDATES, QUERIES = 2048, 8192, 1024


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, dim, v) with v the floored, scaled components, without rows that take no part."""
    v = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    sound = f"`{id_col}` is not null and size(`{vector_col}`) > 0 and forall(`{vector_col}`, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return vectors.where(sound).select(F.col(id_col).cast("long").alias("vec_id"), F.size(vector_col).alias("dim"), v.alias("v"))


def blocks(rows: DataFrame, size: int, extra: list[str]) -> DataFrame:
    """Rows dealt into blocks of about ``size``: (dim, block, ids, v, and the ``extra`` columns), each as bytes."""
    count = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # one row for each length
    of = F.lit(1)
    for dim, n in count.items():
        of = F.when(F.col("dim") == dim, F.lit(max(1, -(-n // size)))).otherwise(of)

    def one(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id")
        flat = np.concatenate([np.asarray(x, np.int64) for x in part["v"]])
        out = {"dim": [key[0]], "block": [key[1]], "ids": [part["vec_id"].to_numpy(np.int64).tobytes()], "v": [flat.tobytes()]}
        return pd.DataFrame(out | {c: [part[c].to_numpy(np.int64).tobytes()] for c in extra})

    # A hash of id and vector deals out rows that share an id as well.
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v", F.monotonically_increasing_id()), of))
    schema = "dim int, block long, ids binary, v binary" + "".join(f", {c} binary" for c in extra)
    return dealt.groupBy("dim", "block").applyInPandas(one, schema)


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """All inner products, exactly."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if top < 2**52:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def _meetings(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each query block beside each candidate block of the same vector length.

    The stated queries meet all rows, in blocks: the query side is repeated for
    each candidate block, and the join is on the pair of block numbers.
    """
    numbers = candidates.groupBy("dim").agg(F.collect_list("block").alias("numbers"))
    left = queries.withColumnRenamed("block", "q_block").join(numbers, "dim").withColumn("block", F.explode("numbers"))
    left = left.drop("numbers").withColumnsRenamed({"ids": "q_ids", "v": "q_v"})
    return left.join(candidates.withColumnsRenamed({"ids": "c_ids", "v": "c_v"}), ["dim", "block"])


def _matrix(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, np.int64).reshape(-1, dim)


def top_k(
    vectors: DataFrame,
    is_query: str,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best candidates among all rows.

    ``is_query`` is a SQL condition on ``vec_id``.
    """
    rows = kept(scaled(vectors, id_col, vector_col, scale), "vectors")
    candidates = kept(blocks(rows, CANDIDATES, []), "candidates")
    peak = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    longest = rows.agg(F.max(F.sqrt(peak))).first()[0] or 0.0
    # By Cauchy and Schwarz no score lies outside; query_no tells repeated query rows apart.
    reach = F.ceil(F.sqrt(peak) * (longest * (1 + 1e-9)) + 1).cast("long")
    asked = kept(
        rows.where(is_query)
        .withColumn("query_no", F.monotonically_increasing_id())
        .withColumn("low", -reach)
        .withColumn("high", reach + 1)
        .withColumn("width", F.expr(f"(high - low + {BINS - 1}) div {BINS}"))
        .withColumn("above", F.lit(0).cast("long")),
        "queries",
    )

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                q, c = _matrix(r.q_v, r.dim), _matrix(r.c_v, r.dim)
                number, q_ids, c_ids = (np.frombuffer(x, np.int64) for x in (r.query_no, r.q_ids, r.c_ids))
                low, high, width, above = (np.frombuffer(x, np.int64) for x in (r.low, r.high, r.width, r.above))
                score = _scores(q, c)
                bin_ = (score - low[:, None]) // width[:, None]
                bin_[(score < low[:, None]) | (score >= high[:, None]) | (q_ids[:, None] == c_ids[None, :])] = -1
                out = []
                for i in range(len(q)):
                    n = np.bincount(bin_[i] + 1, minlength=BINS + 1)[1:]
                    at = np.flatnonzero(n)[::-1]
                    if len(at):
                        enough = int(np.searchsorted(np.cumsum(n[at]), k - above[i])) + 1
                        out.append((np.full(len(at[:enough]), number[i]), at[:enough], n[at[:enough]]))
                if out:
                    yield pd.DataFrame(dict(zip(["query_no", "bin", "n"], map(np.concatenate, zip(*out, strict=True)), strict=True)))

    while True:
        meet = _meetings(blocks(asked, QUERIES, ["query_no", "low", "high", "width", "above"]), candidates)
        counts = meet.mapInPandas(bins, "query_no long, bin long, n long").groupBy("query_no", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_no").orderBy(F.desc("bin"))
        counts = counts.withColumn("to", F.sum("n").over(down)).join(asked.select("query_no", F.col("above").alias("before")), "query_no")
        # The bin where the count reaches k; without one, all candidates belong to the result.
        hit = counts.groupBy("query_no").agg(
            F.max(F.expr("if(before + to >= {0}, struct(bin, before + to - n as over), null)".format(k))).alias("hit")
        )
        step = asked.join(hit, "query_no", "left")
        step = step.select(
            "query_no", "vec_id", "dim", "v",
            F.expr("if(hit is null, low, low + hit.bin * width)").alias("low"),
            F.expr("if(hit is null, high, low + (hit.bin + 1) * width)").alias("high"),
            F.expr(f"if(hit is null or width = 1, width, (width + {BINS - 1}) div {BINS})").alias("width"),
            F.expr("coalesce(hit.over, above)").alias("above"),
            F.expr("hit is not null and width > 1").alias("more"),
        )
        step = kept(step, "bounds")
        asked = step.drop("more")
        if not step.where("more").limit(1).count():
            break

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                number, q_ids, c_ids = (np.frombuffer(x, np.int64) for x in (r.query_no, r.q_ids, r.c_ids))
                low = np.frombuffer(r.low, np.int64)
                score = _scores(_matrix(r.q_v, r.dim), _matrix(r.c_v, r.dim))
                hit = (score >= low[:, None]) & (q_ids[:, None] != c_ids[None, :])
                out = []
                for i in range(len(q_ids)):
                    at = np.flatnonzero(hit[i])
                    # Ids ascend in a block: at the k-th score its first k ids are enough.
                    tie = score[i, at] == low[i]
                    at = np.concatenate([at[~tie], at[tie][:k]])
                    out.append((np.full(len(at), number[i]), np.full(len(at), q_ids[i]), c_ids[at], score[i, at]))
                names = ["query_no", "query_id", "vec_id", "score"]
                yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out, strict=True)), strict=True)))

    meet = _meetings(blocks(asked, QUERIES, ["query_no", "low"]), candidates)
    found = meet.mapInPandas(take, "query_no long, query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_no").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
