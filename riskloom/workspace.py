"""Where jobs put tables, stream checkpoints and models that must outlive an executor."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; a cluster without the setting is
    an error, because a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="riskloom-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def written(spark: SparkSession, df, label: str):
    """Cut lineage: write ``df`` as parquet in the shared folder and read it back."""
    path = fresh_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_frame(spark: SparkSession, rows: list[tuple], schema: str):
    """A few driver-side rows as a local relation, whose size the optimizer knows."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    struct = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = [[row[i] for row in rows] for i in range(len(struct))]
    arrays = [pa.array(values, type=field.type) for values, field in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema=struct)
