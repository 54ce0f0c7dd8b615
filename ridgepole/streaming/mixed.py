"""Convert arriving files of many kinds, each by the dictionary its name asks for."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ridgepole.functions import years
from ridgepole.operators.fixed_width import parse_lines
from ridgepole.operators.layout import Layout
from ridgepole.operators.resolve import resolve_dictionaries
from ridgepole.session import remove_dir
from ridgepole.sources import files
from ridgepole.sources.text_lines import read_lines, stream_lines

UNRESOLVED = "without_dictionary"


def layout_name(dictionary_path: str, layout: Layout) -> str:
    """Folder of the records of a layout: what the dictionary describes, without its year, and a hash of the fields."""
    base = dictionary_path.rstrip("/").rsplit("/", 1)[-1]
    kind = re.sub(r"^(document=)?(\d{4}_)?|(_combined)?(\.\w+)?$", "", unquote(base))
    return f"{kind}-{hashlib.md5(repr(layout.fields).encode()).hexdigest()[:8]}"


def convert_mixed(
    spark: SparkSession,
    folder: str,
    available: Callable[[], DataFrame],
    read_layouts: Callable[[set[str]], Mapping[str, Layout | Exception]],
    output: str,
    checkpoint: str,
    types: Mapping[str, str] | None = None,
    encoding: str = "latin-1",
    glob: str = "*",
    files_per_batch: int | None = None,
    name_level: int = 0,
    prefer: str = "parquet",
) -> StreamingQuery:
    """Take the files not seen before, then stop.

    Each batch is split by layout: the names of its files are resolved against the
    dictionaries ``available`` now, files of one layout are read together and written to
    ``<output>/<layout>/batch_id=<n>`` with their name and year.  A batch that is run again
    after a failure first clears what its earlier attempt left, so every record ends up
    there once.  Names that no dictionary fits, and unreadable dictionaries, are listed
    under ``<output>/without_dictionary``.  ``name_level`` as in ``parsed_stream``.

    The driver handles the names of one batch's files; ``files_per_batch`` bounds them.
    """

    def convert(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        for left in files.glob(session, f"{output}/*/batch_id={batch_id}"):
            remove_dir(session, left)
        paths = [r["file_path"] for r in batch.select("file_path").distinct().toLocalIterator()]
        if not paths:
            return
        named = session.createDataFrame([(p, unquote(p).split("/")[-1 - name_level]) for p in paths], "path string, file_name string")
        # one row for each file of the batch
        rows = resolve_dictionaries(named, available(), "file_name", prefer).collect()
        layouts = read_layouts({r["dictionary_path"] for r in rows if r["dictionary_path"] is not None})
        groups: dict[tuple[str, Layout], list[str]] = {}
        lost = []
        for row in rows:
            layout = layouts.get(row["dictionary_path"])
            if isinstance(layout, Layout):
                typed = layout.typed(dict(types or {}))
                groups.setdefault((layout_name(row["dictionary_path"], typed), typed), []).append(unquote(row["path"]))
            else:
                lost.append((row["file_name"], row["path"], row["dictionary_path"], None if layout is None else str(layout).split("\n")[0]))
        for (name, layout), own in groups.items():
            lines = read_lines(session, own, encoding)
            file_name = F.element_at(F.split(F.col("file_path"), "/"), -1 - name_level)
            tagged = lines.select("value", file_name.alias("source_file"), years.year_in_name(file_name).alias("year"))
            parse_lines(tagged, layout, keep=("source_file", "year")).write.mode("overwrite").parquet(f"{output}/{name}/batch_id={batch_id}")
        if lost:
            listed = session.createDataFrame(lost, "source_file string, path string, dictionary_path string, problem string")
            listed.write.mode("overwrite").parquet(f"{output}/{UNRESOLVED}/batch_id={batch_id}")

    lines = stream_lines(spark, folder, encoding, files_per_batch, glob)
    return (
        lines.writeStream.foreachBatch(convert)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
