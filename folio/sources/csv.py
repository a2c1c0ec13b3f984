"""CSV source: quoted fields with doubled-quote escapes and embedded newlines.

Every column is read as text by header name; typing happens afterwards
with ``typed_cast`` so dirty values become counted NULLs instead of
failing the job or shifting columns.  ``multiLine`` parsing reads each file
in one task and takes one header for all files of a folder (a file with
another one fails the read).  ``multi_line="split"`` reads each file by many
tasks and by its own header (``csv_split``); ``multi_line=False`` says that no
field holds a line break.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from folio.config import HEADER_MAP, NA_TOKENS
from folio.functions.exprs import column
from folio.operators.shaping import Projection, canonical_names, conform
from folio.sources import csv_split

# Reader options matching RFC 4180-style files: a doubled quote escapes a
# quote, backslashes are literal, quoted fields may span lines, and no
# whitespace is trimmed.  NULL detection is left to the NA-token step.
CSV_READ_OPTIONS: dict[str, str] = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "inferSchema": "false",
    "mode": "PERMISSIVE",
    "enforceSchema": "false",  # a file whose header line is another one raises, it is not read by position
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv_text(spark: SparkSession, path: str, *, options: Mapping[str, str] | None = None,
                  on_missing: str = "fail") -> DataFrame | None:
    """All-text frame with the file's own headers, or ``None`` if skipped."""
    opts = dict(CSV_READ_OPTIONS)
    opts.update(options or {})
    try:
        return spark.read.options(**opts).csv(path)
    except AnalysisException as exc:
        if on_missing == "skip" and "PATH_NOT_FOUND" in str(exc):
            return None
        raise


MALFORMED = ("fail", "permissive", "strict")
RECORD = "__malformed"


def check_widths(raw: DataFrame, n_headers: int | Column, malformed: str, sep: str = ",",
                 observation: Observation | None = None) -> DataFrame:
    """Handle rows with more fields than the header, and drop the reader's record column.

    The reader keeps the whole text of a row whose number of fields is wrong
    in that column; its fields are counted outside quotes.  Counts of
    ``wide_rows`` and ``short_rows`` go to ``observation``.
    """
    n_headers = F.lit(n_headers)
    unquoted = F.regexp_replace(F.col(RECORD), '"(?:[^"]|"")*"', "")
    # the reader refuses queries on its record column alone, so a field is looked at, too
    also = F.when(F.coalesce(F.length(column(raw.columns[0])), F.lit(0)) < 0, 1).otherwise(0)
    fields = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep))) + 1 + also
    wide, short = F.coalesce(fields > n_headers, F.lit(False)), F.coalesce(fields < n_headers, F.lit(False))
    if observation is not None:
        raw = raw.observe(observation, F.count_if(wide).alias("wide_rows"), F.count_if(short).alias("short_rows"))
    if malformed == "fail":
        told = F.raise_error(F.concat(F.lit("row with more than "), n_headers.cast("string"), F.lit(" fields: "),
                                      F.substring(RECORD, 1, 200)))
        raw = raw.filter(F.when(wide, told.cast("boolean")).otherwise(True))
    return raw.drop(RECORD)


def text_schema(header: Iterable[str], with_record: bool = True) -> T.StructType:
    """All headers as text, and the column that check_widths() reads."""
    return T.StructType([T.StructField(h, T.StringType()) for h in [*header, *([RECORD] if with_record else [])]])


def _nothing(spark: SparkSession, schema: T.StructType, row_order_col: str | None) -> Projection:
    empty = spark.createDataFrame([], schema)
    if row_order_col:
        empty = empty.withColumn(row_order_col, F.lit(None).cast("long"))
    return Projection(frame=empty, missing=schema.fieldNames(), found=False)


def _read_split(spark: SparkSession, path: str, schema: T.StructType, header_map: Mapping[str, str],
                na_tokens: Iterable[str], on_missing: str, observation: Observation | None, options: Mapping[str, str],
                row_order_col: str | None, malformed: str, widths: Observation | None) -> Projection:
    """Each file by many tasks and by its own header; rows come together by name."""
    opts = {**CSV_READ_OPTIONS, **options}
    if opts["quote"] != '"' or opts["escape"] != '"' or opts.get("encoding", "UTF-8").upper() != "UTF-8":
        raise ValueError('multi_line="split" reads UTF-8 files with double quotes')
    sep = opts.get("sep", ",")
    try:
        records = csv_split.read_records(spark, path, sep)
    except AnalysisException as exc:
        if on_missing == "skip" and "PATH_NOT_FOUND" in str(exc):
            return _nothing(spark, schema, row_order_col)
        raise
    names = [canonical_names(h, header_map) for h in records.headers]
    strict = malformed == "strict"
    raw = csv_split.parse_records(records, names, {**opts, **({"mode": "FAILFAST"} if strict else {})},
                                  None if strict else RECORD)
    if not strict:
        fields = F.lit(0)
        for no, own in enumerate(names):
            fields = F.when(F.col(csv_split.HEADER_NO) == no, len(own)).otherwise(fields)
        raw = check_widths(raw, fields, malformed, sep, widths)
    raw = raw.drop(csv_split.HEADER_NO)
    order = [row_order_col] if row_order_col else []
    raw = raw.withColumnRenamed(csv_split.PLACE, row_order_col) if row_order_col else raw.drop(csv_split.PLACE)
    proj = conform(raw, schema, header_map={}, na_tokens=na_tokens, observation=observation, keep=order)
    wanted = schema.fieldNames()
    report = [(no, header, [c for c in wanted if c not in own], [h for h, c in zip(header, own) if c not in wanted])
              for no, (header, own) in enumerate(zip(records.headers, names))]
    by_header = spark.createDataFrame(report, f"{csv_split.HEADER_NO} int, header array<string>, "
                                              "missing array<string>, dropped array<string>")
    proj.files = records.files.join(F.broadcast(by_header), csv_split.HEADER_NO).select(
        "file", "header", "missing", "dropped")
    proj.dropped = list(dict.fromkeys(h for _, _, _, dropped in report for h in dropped))
    return proj


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType, *,
                   header_map: Mapping[str, str] = HEADER_MAP,
                   na_tokens: Iterable[str] = NA_TOKENS,
                   on_missing: str = "fail",
                   observation: Observation | None = None,
                   options: Mapping[str, str] | None = None,
                   row_order_col: str | None = None,
                   malformed: str = "fail",
                   multi_line: bool | str = True,
                   widths: Observation | None = None) -> Projection:
    """Read a CSV file or folder into ``schema``: rename, project, NA tokens, cast.

    Returns the typed frame with the names of missing target columns and of
    dropped input headers.  ``on_missing="skip"`` gives an empty frame with
    the target schema when the input does not exist.

    A row with fewer fields than the header is padded with NULL.  A row with
    more fails the read (``malformed="fail"``), or loses the surplus
    (``"permissive"``); ``"strict"`` fails on fewer fields, too.  ``widths``
    observes the ``wide_rows`` and ``short_rows`` of the first two.

    ``multi_line=False`` states that no quoted field holds a line break; the
    reader may then split a file over many tasks.  ``"split"`` splits files with line
    breaks in fields, too, and maps each file by its own header; the result then has
    ``files``, with the target columns that each file lacks and its headers dropped.

    ``row_order_col`` adds a long column numbering rows in load order.  With
    ``"split"`` they are numbered by file name and place from 0 on, however the files are
    split.  Otherwise it is ``monotonically_increasing_id`` right after the scan: exactly file
    order for one file, and stable for the same file layout otherwise.
    """
    if malformed not in MALFORMED:
        raise ValueError(f"malformed must be one of {MALFORMED}")
    if multi_line not in (True, False, "split"):
        raise ValueError('multi_line must be True, False or "split"')
    if multi_line == "split":
        return _read_split(spark, path, schema, header_map, na_tokens, on_missing, observation, options or {},
                           row_order_col, malformed, widths)
    opts = {"multiLine": str(multi_line).lower(), **(options or {})}
    raw = read_csv_text(spark, path, options=opts, on_missing=on_missing)
    if raw is None:
        return _nothing(spark, schema, row_order_col)
    header = raw.columns
    if malformed == "strict":
        raw = read_csv_text(spark, path, options={**opts, "mode": "FAILFAST"})
    else:
        kept = {**CSV_READ_OPTIONS, **opts, "columnNameOfCorruptRecord": RECORD}
        raw = spark.read.options(**kept).schema(text_schema(header)).csv(path)
        raw = check_widths(raw, len(header), malformed, opts.get("sep", ","), widths)
    proj = conform(raw, schema, header_map=header_map, na_tokens=na_tokens,
                   observation=observation)
    if row_order_col:
        proj.frame = proj.frame.withColumn(row_order_col, F.monotonically_increasing_id())
    return proj
