"""SNK-1 CSV, SNK-2 JSON, SNK-3 Parquet, SNK-4 replicated publish.

Writers never overwrite what they read: a catalog version goes to a new
directory and a small pointer is flipped afterwards (see plans/catalog.py).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.spec import DEFAULT_CSV_SEPARATOR

REPLICA_POINTER = "version int"


def write_csv(df: DataFrame, path: str, sep: str = DEFAULT_CSV_SEPARATOR, mode: str = "error",
              encoding: str = "UTF-8") -> str:
    (df.write.mode(mode).option("header", True).option("sep", sep).option("encoding", encoding)
     .option("quote", '"').option("escape", '"').option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def write_json(df: DataFrame, path: str, mode: str = "error") -> str:
    """JSON lines, one record per line, per table directory."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
    return path


def write_json_document(tables: Mapping[str, DataFrame], path: str, mode: str = "error") -> str:
    """The whole catalog as documents ``{table: [record]}``, the layout in which
    multi-table metadata is posted: one record per document and line, so that
    no table has to fit into one value. Reading the lines as documents
    (``scan_json_tables``) gives the tables back."""
    out = None
    for t, df in tables.items():
        record = F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
        line = df.select(F.to_json(F.struct(record.alias(t)), {"ignoreNullFields": "false"}).alias("value"))
        out = line if out is None else out.unionByName(line)
    out.write.mode(mode).text(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> str:
    df.write.mode(mode).parquet(path)
    return path


def replica_folder(spark: SparkSession, target: str) -> str:
    """Where the newest whole version of a replica is: its pointer's version, or the target itself."""
    try:
        latest = spark.read.schema(REPLICA_POINTER).json(f"{target}/_current").agg(F.max("version")).first()[0]
    except AnalysisException:
        latest = None
    return target if latest is None else f"{target}/v={latest}"


_WRITERS = {"csv": write_csv, "json": write_json, "parquet": write_parquet}


def publish(tables: Mapping[str, DataFrame], targets: Sequence[str], sep: str = DEFAULT_CSV_SEPARATOR,
            version: int | None = None) -> dict:
    """SNK-4: the same catalog to several targets in mixed formats; each table
    to ``<target>/<table>`` (JSON: all tables as documents in ``<target>``), or with
    ``version`` under ``<target>/v=<version>`` followed by a pointer, so that readers see whole versions only and the
    next batch writes beside them. Tables are persisted once and written to
    every target; success when at least one target is written."""
    cached = {t: df.persist() for t, df in tables.items()}
    written, errors = [], {}
    try:
        for target in targets:
            fmt = target.rsplit(".", 1)[-1].lower() if "." in target.rsplit("/", 1)[-1] else "parquet"
            writer = _WRITERS.get(fmt)
            if writer is None:
                errors[target] = f"unsupported format {fmt!r}"
                continue
            try:
                folder = target if version is None else f"{target}/v={version}"
                if fmt == "json":  # the shape in which multi-table metadata is posted
                    write_json_document(cached, folder, mode="overwrite")
                for t, df in cached.items() if fmt != "json" else ():
                    if fmt == "csv":
                        writer(df, f"{folder}/{t}", sep=sep, mode="overwrite")
                    else:
                        writer(df, f"{folder}/{t}", mode="overwrite")
                if version is not None:
                    spark = next(iter(cached.values())).sparkSession
                    (spark.createDataFrame([(version,)], REPLICA_POINTER).coalesce(1)
                     .write.mode("append").json(f"{target}/_current"))
                written.append(target)
            except Exception as exc:  # one failing replica must not stop the others
                errors[target] = str(exc)
    finally:
        for df in cached.values():
            df.unpersist()
    if not written:
        raise RuntimeError(f"no catalog replica written: {errors}")
    return {"written": written, "errors": errors}
