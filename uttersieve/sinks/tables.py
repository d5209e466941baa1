"""Write logs, tables, id lists and reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttersieve.operators.order import BLOCK_ROWS, positions, sorted_positions
from uttersieve.session import materialize


def append_log(rows: DataFrame, path: str) -> None:
    """Add matched rows to the log."""
    rows.write.mode("append").partitionBy("subset").parquet(path)


def save_table(rows: DataFrame, path: str) -> None:
    """Save the curated table; without rows it is empty, not missing."""
    rows.write.partitionBy("subset").parquet(path)


def write_ids(
    ids: DataFrame, path: str, id_col="utt_id", seq="seq", folder="subset", replace="dynamic"
) -> None:
    """One id per line and one folder per subset, in order of file name and line.
    A list written again replaces its own folder only, or with ``replace="static"`` all
    that is below ``path``."""
    ids.select(folder, seq, F.col(id_col).cast("string").alias("value")).repartitionByRange(
        folder, seq
    ).sortWithinPartitions(folder, seq).select(folder, "value").write.mode(
        "overwrite"
    ).option("partitionOverwriteMode", replace).partitionBy(folder).text(path)


def csv_field(col):
    """Quote a field holding a comma, a quote or a line break."""
    c = F.col(col) if isinstance(col, str) else col
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(c.rlike('[,"\r\n]'), quoted).otherwise(c)


def id_rows(
    ids: DataFrame,
    per_line: int,
    id_col="utt_id",
    seq="seq",
    block_rows=BLOCK_ROWS,
) -> DataFrame:
    """``subset, line, value``: the ids in order, comma-separated, ``per_line`` ids a line.

    The format is lines of one length at every size; the last may be short.
    """
    at = positions(ids.select("subset", seq, id_col), ["subset"], seq, "_at", None, block_rows)
    item = F.struct("_at", csv_field(F.col(id_col).cast("string")).alias("id"))
    ordered = F.transform(F.array_sort(F.collect_list(item)), lambda i: i["id"])
    return (
        at.withColumn("line", F.expr(f"(_at - 1) div {int(per_line)} + 1"))
        .groupBy("subset", "line")
        .agg(F.array_join(ordered, ",").alias("value"))
    )


def write_id_rows(ids: DataFrame, path: str, per_line: int, **options) -> None:
    """Ids as comma-separated lines of ``per_line`` ids, one folder per subset."""
    id_rows(ids, per_line, **options).repartitionByRange("subset", "line").sortWithinPartitions(
        "subset", "line"
    ).select("subset", "value").write.partitionBy("subset").text(path)


def write_results(ids: DataFrame, summary: DataFrame, path: str, id_col="utt_id") -> None:
    """Ids of each subset below a folder named after its result.

    The folder name holds the counts, so a later result has another name: ``path``
    holds the lists of the latest call only, each id once.
    The names, one row per subset, are written down first: their size is known,
    so a subset with most of the ids is not brought to one task to meet its name.
    """
    names = materialize(summary.select("subset", "name"), "names")
    named = ids.join(names, "subset")
    write_ids(named, path, id_col, folder="name", replace="static")


def with_index(rows: DataFrame, order: str, name="") -> DataFrame:
    """0-based index in the order of a unique column, as the first column."""
    at = sorted_positions(rows, [], [order], "_at")
    return at.select((F.col("_at") - 1).alias(name), *rows.columns)


def write_tsv(rows: DataFrame, path: str, order: str) -> None:
    """Tab-separated with a header and a leading 0-based index column.

    The index's head is empty.  Only the first file has the header, as one file read
    after the other in name order is the table.
    """
    indexed = with_index(rows, order, "_index")
    kept = [c for c in rows.columns if c != order]
    texts = [F.col("_index").cast("string"), *[F.col(c).cast("string") for c in kept]]

    def line(cells):
        quoted = [
            F.when(c.rlike('[\t"\r\n]'), F.concat(
                F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')
            )).otherwise(F.coalesce(c, F.lit("")))
            for c in cells
        ]
        return F.concat_ws("\t", *quoted)

    head = line([F.lit(c) for c in ["", *kept]])
    body = line(texts)
    first = F.col("_index") == 0
    lines = indexed.select(
        "_index", F.when(first, F.concat(head, F.lit("\n"), body)).otherwise(body).alias("value")
    )
    lines.repartitionByRange("_index").sortWithinPartitions("_index").select("value").write.text(
        path
    )


def flat_cells(rows: DataFrame) -> DataFrame:
    """Arrays, structs and maps as JSON text, as CSV has no nested cells."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return rows.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in rows.schema.fields
        ]
    )


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header; nested cells as JSON."""
    flat_cells(rows).write.option("header", True).option("escape", '"').csv(path)


def write_features(rows: DataFrame, path: str) -> None:
    """One row per audio file: ``speaker, path, name, features, error``."""
    rows.select("speaker", "path", "name", "features", "error").write.mode("append").partitionBy(
        "speaker"
    ).parquet(path)
