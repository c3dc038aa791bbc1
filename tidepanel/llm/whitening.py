"""Embedding whitening on MLlib's distributed block matrices.

Vectors are cut to whole numbers, x = floor(scale * c) + shift, and each distinct x vector counts once in the fit.
Centred rows are packed into blocks and indexed twice: as one tall column of blocks A, whose product A' A (split
along its long side, so that each task multiplies a few blocks and sends one small sum) is the scatter matrix, and
as a grid of blocks, one column per input split, whose product with a block-diagonal matrix of equal whitening blocks
projects every row. The grid keeps MLlib's partitioner square, so tasks grow in number with the blocks. Only matrices
of dimension x dimension come to the driver, for a local eigendecomposition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidepanel.llm.common import Tables

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Numbers of one block, 8 bytes each, and blocks that one task of the scatter product takes.
BLOCK_CELLS, BLOCKS_A_TASK = 1 << 17, 4
#: Variance, as a share of the total, below which a component counts as having none.
NO_VARIANCE = 1e-12

#: A dense matrix as MLlib's own type stores it; a table written with it can be read as MatrixUDT and the other way round.
MATRIX = MatrixUDT.sqlType()


def whole_vectors(embeddings: DataFrame, id_col: str, vec_col: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """id and x of each usable vector, all of the most common length."""
    c = F.col(vec_col).cast("array<double>")
    usable = F.forall(c, lambda e: F.coalesce(F.abs(e) * scale < float(1 << 62), F.lit(False)))  # NaN is above all numbers
    rows = embeddings.where(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)).where(usable)
    rows = rows.select(F.col(id_col).alias("id"), F.transform(c, lambda e: F.floor(e * scale) + F.lit(shift)).alias("x"))
    lengths = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return rows.where(F.size("x") == (lengths["dim"] if lengths else 0))


def blocks_of(rows: DataFrame, tables: Tables, n: int, sums: list[int], keep: bool) -> DataFrame:
    """Centred rows as dense blocks: (split, seq, ids, deviations, matrix). Blocks hold consecutive rows of one input split."""
    dim = len(sums)
    size = max(1, BLOCK_CELLS // dim)
    highest = max(map(abs, sums))
    names = ["split", "seq", "ids", "deviations", "matrix"]
    id_type = rows.schema["id"].dataType if keep else T.LongType()
    schema = T.StructType([T.StructField("split", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("ids", T.ArrayType(id_type)),
                           T.StructField("deviations", T.ArrayType(T.LongType())), T.StructField("matrix", MATRIX)])

    def run(batches):
        split, seq, held, ids = TaskContext.get().partitionId(), 0, [], []

        def block(x, ids):
            if n * float(np.abs(x).max()) < 2e18 and highest < 2e18:
                apart = n * x - np.array(sums)
            else:  # in whole numbers of any size
                apart = n * x.astype(object) - np.array(sums, dtype=object)
            far = float(np.abs(apart).max())
            if dim * far * far < 9e18:
                deviations = (apart * apart).sum(axis=1).tolist()
            else:  # none where it isn't a long
                deviations = [d if (d := sum(v * v for v in r)) < 1 << 63 else None for r in apart.tolist()]
            matrix = {"type": 1, "numRows": len(x), "numCols": dim, "colPtrs": None, "rowIndices": None, "values": (apart / n).astype("f8").ravel(), "isTransposed": True}
            row = {"split": split, "seq": seq, "ids": ids, "deviations": deviations if keep else [], "matrix": matrix}
            return pa.RecordBatch.from_arrays([pa.array([row[c]], type=arrow[c]) for c in names], names=names)

        arrow = {"split": pa.int64(), "seq": pa.int64(), "ids": id_arrow, "deviations": pa.list_(pa.int64()),
                 "matrix": pa.struct([("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())),
                                      ("rowIndices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_())])}
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            held = np.concatenate([held, x]) if len(held) else x
            ids = ids + batch.column("id").to_pylist() if keep else []
            while len(held) >= size:
                yield block(held[:size], ids[:size])
                held, ids, seq = held[size:], ids[size:], seq + 1
        if len(held):
            yield block(held, ids)

    id_arrow = pa.list_(to_arrow_type(id_type))
    cols = ["id", "x"] if keep else ["x"]
    return tables.write(rows.select(*cols).mapInArrow(run, schema))


def block_matrix(blocks: DataFrame, i, j, rows_per_block: int, cols_per_block: int, n_rows: int, n_cols: int) -> BlockMatrix:
    """A written table of blocks as an MLlib block matrix; ``i`` and ``j`` are the blocks' coordinates."""
    schema = T.StructType([T.StructField(f.name, MatrixUDT() if f.name == "matrix" else f.dataType) for f in blocks.schema])
    typed = blocks.sparkSession.read.schema(schema).parquet(blocks.written_at)
    place = F.struct(i.cast("long").alias("_1"), j.cast("long").alias("_2"))
    return BlockMatrix(callMLlibFunc("createBlockMatrix", typed.select(place, "matrix"), rows_per_block, cols_per_block, n_rows, n_cols), rows_per_block, cols_per_block)


def product(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """a b, with the inner dimension cut into ``splits`` tasks."""
    return BlockMatrix(a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits), a.rowsPerBlock, b.colsPerBlock)


def scatter(blocks: DataFrame, dim: int, shape: tuple[int, int, int], size: int) -> np.ndarray:
    """A' A over all blocks; only the result of dim x dim leaves the cluster."""
    splits, _, count = shape
    number = F.col("seq") * splits + F.col("split")
    tall = block_matrix(blocks, number, F.lit(0), size, dim, size * splits * shape[1], dim)
    return product(tall.transpose(), tall, max(1, -(-count // BLOCKS_A_TASK))).toLocalMatrix().toArray()


def shape_of(blocks: DataFrame) -> tuple[int, int, int]:
    """Splits, longest run of blocks in a split, and number of blocks."""
    r = blocks.agg(F.max("split"), F.max("seq"), F.count("*")).first()
    return (r[0] + 1, r[1] + 1, r[2]) if r[2] else (0, 0, 0)


def project(blocks: DataFrame, shape: tuple[int, int, int], size: int, matrix: np.ndarray, tables: Tables) -> DataFrame:
    """(split, seq, matrix) with every block times ``matrix``, as a written table."""
    splits, longest, _ = shape
    dim, k = matrix.shape
    spark = blocks.sparkSession
    wide = block_matrix(blocks, F.col("seq"), F.col("split"), size, dim, size * longest, dim * splits)
    one = DenseMatrix(dim, k, matrix.T.ravel())
    places = spark.sparkContext.parallelize(range(splits), max(1, min(splits, spark.sparkContext.defaultParallelism)))
    diagonal = BlockMatrix(places.map(lambda s: ((s, s), one)), dim, k, dim * splits, k * splits)
    found = callMLlibFunc("getMatrixBlocks", product(wide, diagonal, 1)._java_matrix_wrapper._java_model).toDF("place", "matrix")
    path = tables.write(found.select(F.col("place")["_1"].cast("long").alias("seq"), F.col("place")["_2"].cast("long").alias("split"), "matrix")).written_at
    out = spark.read.schema(T.StructType([T.StructField("seq", T.LongType()), T.StructField("split", T.LongType()), T.StructField("matrix", MATRIX)])).parquet(path)
    out.written_at = path
    return out


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, dict]:
    """Whitened coordinates of all usable vectors, and the model.

    The frame has one row per vector and component: id, component (from 1, by falling variance), n (distinct vectors of the
    fit), deviation, whitened, explained, identity_error. The model holds n, sums, values, vectors and whitening. A vector that
    is null or empty, or has a null or non-finite entry or one whose x is no long (2^62 / scale and above), is left out; so is one not of
    the most common length (of equally common ones the longest). Repeated rows and ids each have their rows; ties of equal
    variance take the order of the decomposition. Components beyond the dimension don't exist; one without variance has a null whitened and isn't
    part of identity_error. A deviation beyond a long is null. An empty table gives no rows. Other columns are ignored.
    """
    tables = Tables(embeddings.sparkSession, "whitening")
    rows = tables.write(whole_vectors(embeddings, id_col, vec_col))
    fit = tables.write(rows.groupBy("x").agg(F.lit(1)).select("x"))
    n = fit.count()
    spec = f"`{id_col}` {rows.schema['id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not n:
        return embeddings.sparkSession.createDataFrame([], spec), {}
    place = F.posexplode("x").alias("i", "v")
    totals = fit.select(place).groupBy("i").agg(F.sum(F.col("v").cast("decimal(19,0)")).alias("s")).orderBy("i").collect()  # one number per dimension
    sums = [int(r["s"]) for r in totals]
    dim = len(sums)
    size = max(1, BLOCK_CELLS // dim)
    fit_blocks = blocks_of(fit, tables, n, sums, keep=False)
    shape = shape_of(fit_blocks)
    values, vectors = np.linalg.eigh(scatter(fit_blocks, dim, shape, size) / n)
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
    total = float(values.sum())
    k = min(components, dim)
    live = values[:k] > NO_VARIANCE * max(total, 1e-300)
    matrix = vectors[:, :k] * np.where(live, 1.0 / np.sqrt(np.where(live, values[:k], 1.0)), 0.0)

    fit_white = project(fit_blocks, shape, size, matrix, tables)
    covariance = scatter(fit_white, k, shape, size) / n
    error = float(np.abs((covariance - np.eye(k))[np.ix_(live, live)]).max()) if live.any() else 0.0
    tables.drop(fit_white)
    tables.drop(fit_blocks)
    tables.drop(fit)

    blocks = blocks_of(rows, tables, n, sums, keep=True)
    white = project(blocks, shape_of(blocks), size, matrix, tables)
    both = blocks.select("split", "seq", "ids", "deviations").join(white.select("split", "seq", F.col("matrix.numRows").alias("m"), F.col("matrix.values").alias("values")), ["split", "seq"])
    row = both.select("m", "values", F.posexplode(F.arrays_zip("ids", "deviations")).alias("i", "row"))
    numbers = F.array(*[F.struct(F.lit(c + 1).alias("component"), (F.get("values", F.col("m") * c + F.col("i")) if live[c] else F.lit(None).cast("double")).alias("whitened"),
                                 F.lit(float(values[c] / total) if total else 0.0).alias("explained")) for c in range(k)])
    out = row.select(F.col("row.ids").alias(id_col), F.col("row.deviations").alias("deviation"), F.explode(numbers).alias("c"))
    out = out.select(id_col, F.col("c.component").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", F.col("c.whitened").alias("whitened"),
                     F.col("c.explained").alias("explained"), F.lit(error).alias("identity_error"))
    return out, {"n": n, "sums": sums, "values": values, "vectors": vectors, "whitening": matrix}
