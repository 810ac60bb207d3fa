"""Whitening of embeddings by weighted multiplicity covariance.

Vectors become whole numbers, so that equal ones are told exactly. Identical vectors are one row with their count; the
count, or one, is the weight of that row in the fit. Sums are exact; the covariance is a weighted product of centred
blocks, added up over the tasks. Each different vector is whitened once and joined back to its rows. A vector that many
rows share is joined under several salts.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import with_fields
from larderline.session import cut


@dataclass(frozen=True)
class WhitenRules:
    scale: int = 1024            # an entry c becomes floor(scale * c) + shift
    shift: int = 100_000
    components: int = 8
    weights: str = "counts"      # of a different vector in the fit: "counts" of its rows, or "one"
    flat: float = 1e-12          # an eigenvalue up to this share of the largest has no whitened value
    hot: int = 1000              # a vector on one of so many rows is joined back under several salts
    salts: int = 64


@dataclass(frozen=True)
class Whitening:
    """A fit. Sums are of the shifted numbers; components fall by eigenvalue, one a row, of unit length."""
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)


WIDTHS = (2, 4, 8)  # bytes of a packed entry


def packed(batch: pa.RecordBatch, vector: str, scale: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Rows of a batch that have a vector of finite entries, their dimensions, and floor(scale * c) of all entries in the fewest bytes."""
    column = batch.column(vector)
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null entry is no number
    end = np.cumsum(size)
    odd = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    keep = np.flatnonzero(pc.is_valid(column).to_numpy(zero_copy_only=False) & (odd[end] == odd[end - size]))
    out = []
    for k in keep:
        x = np.floor(flat[end[k] - size[k]:end[k]] * scale)
        most = np.abs(x).max(initial=0)
        if most >= 2.0 ** 62:
            raise ValueError(f"an entry of {most / scale:g} is beyond 64-bit whole numbers")
        out.append(x.astype(f"<i{next(w for w in WIDTHS if most < 2.0 ** (8 * w - 1))}").tobytes())
    return keep, size[keep], out


def unpacked(values: list[bytes], dim: int) -> np.ndarray:
    """A row of 64-bit whole numbers for each packed vector."""
    out, width = np.empty((len(values), dim), np.int64), np.array([len(v) for v in values]) // max(dim, 1)
    for w in WIDTHS:
        if (at := np.flatnonzero(width == w)).size:
            out[at] = np.frombuffer(b"".join(values[k] for k in at), f"<i{w}").reshape(-1, dim)
    return out


def coded(df: DataFrame, columns: list[str], vector: str, rules: WhitenRules) -> DataFrame:
    """``columns`` of the rows with a vector of finite entries, with dim, x (packed) and at, a running number below ``rules.salts``."""
    names = [f"c{k}" for k in range(len(columns))]
    slim = df.select(*(F.col(c).alias(n) for c, n in zip(columns, names)), F.col(vector).alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            keep, dim, x = packed(batch, "vector", rules.scale)
            at = (done + np.arange(len(keep))) % rules.salts
            done += len(keep)
            kept = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([kept.column(n) for n in names] + [pa.array(dim, pa.int32()), pa.array(x, pa.binary()), pa.array(at, pa.int32())],
                                             [*names, "dim", "x", "at"])

    return slim.mapInArrow(run, with_fields(slim, names, "dim int, x binary, at int"))


def multiplicities(df: DataFrame, vector: str = "embedding", rules: WhitenRules = WhitenRules()) -> DataFrame:
    """Each different vector (dim, x) with the number of its rows, and its weight in the fit. Written once."""
    if rules.weights not in ("counts", "one"):
        raise ValueError(f"weights are counts or one, not {rules.weights}")
    counted = coded(df, [], vector, rules).groupBy("dim", "x").agg(F.count("*").alias("rows"))
    return cut(counted.withColumn("weight", F.col("rows") if rules.weights == "counts" else F.lit(1).cast("long")))


def weighted(w: np.ndarray, x: np.ndarray) -> list[int]:
    """Exact weighted sums of the columns."""
    safe = int(w.sum()) * (int(np.abs(x).max(initial=0)) + 1) < 1 << 62
    return [int(v) for v in (w @ x if safe else w.astype(object) @ x.astype(object))]


def moments(distinct: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Weight of all vectors of ``dim`` entries, and the exact weighted sum of each entry, without the shift."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * (dim + 1)
        for batch in batches:
            w = batch.column("weight").to_numpy(zero_copy_only=False)
            part = [int(w.sum()), *weighted(w, unpacked(batch.column("x").to_pylist(), dim))]
            sums = [a + b for a, b in zip(sums, part)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dim + 1), pa.int32()), pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))], ["k", "s"])

    rows = distinct.where(F.col("dim") == dim).select("x", "weight").mapInArrow(run, "k int, s decimal(38,0)")
    got = {r["k"]: int(r["s"]) for r in rows.groupBy("k").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()}
    return got.get(0, 0), [got.get(k + 1, 0) for k in range(dim)]


def centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean of each entry as a whole number and what is left of it, at most a half."""
    near = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(near, np.int64), np.array([(s - n * r) / n for s, r in zip(sums, near)])


def covariance(distinct: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Weighted covariance (divisor n): centred blocks are multiplied in each task, and the products' entries added up."""
    dim, (near, rest) = len(sums), centre(n, sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            y = (unpacked(batch.column("x").to_pylist(), dim) - near) - rest
            total += (y * batch.column("weight").to_numpy(zero_copy_only=False)[:, None]).T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([total[i, i:].tolist() for i in range(dim)], pa.list_(pa.float64()))], ["i", "v"])

    rows = distinct.where(F.col("dim") == dim).select("x", "weight").mapInArrow(run, "i int, v array<double>")
    cells = rows.select("i", F.posexplode("v").alias("k", "v")).groupBy("i", "k").agg(F.sum("v").alias("v"))
    out = np.zeros((dim, dim))
    for r in cells.collect():  # a number for each two entries
        out[r["i"], r["i"] + r["k"]] = out[r["i"] + r["k"], r["i"]] = r["v"] / n
    return out


def fit(distinct: DataFrame) -> Whitening | None:
    """The fit over the vectors of the dimension with the most weight (the smaller of two alike). None without any."""
    dim = (distinct.where("dim > 0").groupBy("dim").agg(F.sum("weight").alias("w")).orderBy(F.desc("w"), "dim").first() or [None])[0]
    if dim is None:
        return None
    n, sums = moments(distinct, dim)
    cov = covariance(distinct, n, sums)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors.T[::-1]
    side = np.sign(vectors[np.arange(dim), np.abs(vectors).argmax(1)])  # the largest entry is positive
    return Whitening(n, tuple(sums), values, vectors * side[:, None], float(np.trace(cov)))


def transform(distinct: DataFrame, model: Whitening, rules: WhitenRules = WhitenRules()) -> DataFrame:
    """x, rows, weight, deviation (exact: sum over entries of (n * x - S) squared) and whitened (an array) of each different vector."""
    (near, rest), dim, n = centre(model.n, list(model.sums)), model.dim, model.n
    kept = min(rules.components, dim)
    told = model.values[:kept] > rules.flat * max(model.values[0], 0.0)
    turn = (model.vectors[:kept] / np.sqrt(np.where(told, model.values[:kept], 1.0))[:, None]).T
    sums = np.array(model.sums, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column("x").to_pylist(), dim)
            most = n * int(np.abs(x).max(initial=0)) + max(map(abs, model.sums))
            far = n * x - sums.astype(np.int64) if most * most * dim < 1 << 62 else n * x.astype(object) - sums
            z = ((x - near) - rest) @ turn
            yield pa.RecordBatch.from_arrays(
                [batch.column("x"), batch.column("rows"), batch.column("weight"), pa.array([Decimal(int(v)) for v in (far * far).sum(1)], pa.decimal128(38, 0)),
                 pa.array([[v if t else None for v, t in zip(row, told)] for row in z.tolist()], pa.list_(pa.float64()))],
                ["x", "rows", "weight", "deviation", "whitened"])

    slim = distinct.where(F.col("dim") == dim).select("x", "rows", "weight")
    return cut(slim.mapInArrow(run, "x binary, rows long, weight long, deviation decimal(38,0), whitened array<double>"))


def identity_error(whitened: DataFrame, model: Whitening, rules: WhitenRules = WhitenRules()) -> float | None:
    """Largest absolute entry of the weighted covariance of the whitened vectors minus the identity; None if no component has a spread."""
    z = [F.col("whitened")[k] for k in range(min(rules.components, model.dim)) if model.values[k] > rules.flat * max(model.values[0], 0.0)]
    if not z:
        return None
    mean = whitened.agg(*(F.sum(F.col("weight") * c) / model.n for c in z)).first()
    pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    got = whitened.agg(*(F.sum(F.col("weight") * (z[i] - mean[i]) * (z[j] - mean[j])) / model.n for i, j in pairs)).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(got, pairs))


def joined(df: DataFrame, ids: list[str], whitened: DataFrame, model: Whitening, vector: str, rules: WhitenRules) -> DataFrame:
    """deviation and whitened for each row, by the vector. Hot vectors, at most ``rules.hot`` of them, are told by a broadcast."""
    rows = coded(df, ids, vector, rules).where(F.col("dim") == model.dim)
    total = whitened.agg(F.sum("rows")).first()[0]
    is_hot = F.col("rows") * rules.hot >= total
    hot = whitened.where(is_hot).select(F.col("x").alias("hot"))
    salted = rows.join(F.broadcast(hot), F.col("x") == F.col("hot"), "left").withColumn("salt", F.when(F.col("hot").isNotNull(), F.col("at")).otherwise(0))
    table = whitened.select("x", "deviation", "whitened", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(rules.salts - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    return salted.join(table, ["x", "salt"]).select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(ids)), "deviation", "whitened")


def whiten(df: DataFrame, ids: tuple[str, ...] = ("vec_id",), vector: str = "embedding", rules: WhitenRules = WhitenRules()) -> DataFrame:
    """``ids`` of each row with deviation, whitened (an array, components in order), n, explained (an array) and identity_error.

    A null vector, or one with a null or non-finite entry, goes. Vectors of another length than that of most rows (the
    smaller of two alike), and empty ones, go too. Null and repeated ids stay, a result a row. Other columns aren't
    read, whatever their names. A component without spread (all vectors alike, or fewer than entries) has a null for
    its whitened value, and without any spread explained is null, too. An empty table, or one without a vector, gives
    an empty result. An entry beyond 2**62 / scale is an error.
    """
    distinct = multiplicities(df, vector, rules)
    model = fit(distinct)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*ids).schema.fields)
    if model is None:
        return df.sparkSession.createDataFrame([], f"{schema}, deviation decimal(38,0), whitened array<double>, n long, explained array<double>, identity_error double")
    whitened = transform(distinct, model, rules)
    share = [float(v) / model.trace if model.trace > 0 else None for v in model.values[:rules.components]]
    return (joined(df, list(ids), whitened, model, vector, rules)
            .withColumns({"n": F.lit(model.n).cast("long"), "explained": F.array(*(F.lit(v).cast("double") for v in share)),
                          "identity_error": F.lit(identity_error(whitened, model, rules)).cast("double")}))


def query(embeddings: DataFrame, rules: WhitenRules = WhitenRules()) -> DataFrame:
    """A row for each vector and component. A deviation beyond a long is null."""
    each = whiten(embeddings, rules=rules)
    return (each.select("vec_id", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "explained", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened", F.col("explained")[F.col("at")].alias("explained"), "identity_error"))
