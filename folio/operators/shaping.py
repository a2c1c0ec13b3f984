"""Load shaping: header renames, projection, NA tokens and typed casts.

All four are projections, so they fuse into the scan's codegen stage and
cost no extra pass over the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.config import HEADER_MAP, NA_TOKENS
from folio.functions.exprs import column, null_tokens, rejected, safe_cast


class DuplicateHeaderError(ValueError):
    """Two input headers resolve to the same column name."""


def _case_duplicates(columns: list[str], header_map: Mapping[str, str]) -> list[str]:
    """Mapped headers that Spark's CSV reader renamed because they collided.

    Headers equal up to case come back as ``<header><position>`` (``Title``
    and ``title`` -> ``Title0``, ``title1``).  A column counts only when at
    least one other column was renamed the same way, so a genuine header
    such as ``Title2`` is not mistaken for one.
    """
    bases: dict[str, list[str]] = {}
    for pos, name in enumerate(columns):
        suffix = str(pos)
        if name.endswith(suffix) and len(name) > len(suffix):
            base = name[: -len(suffix)]
            bases.setdefault(base.lower(), []).append(base)
    return sorted({b for group in bases.values() if len(group) > 1
                   for b in group if b in header_map})


def canonical_names(columns: list[str], header_map: Mapping[str, str] = HEADER_MAP) -> list[str]:
    """The canonical name of each header; unmapped names stay as they are.

    Raises ``DuplicateHeaderError`` when two inputs land on one name,
    including headers that differ only by case.
    """
    dups = _case_duplicates(columns, header_map)
    if dups:
        raise DuplicateHeaderError(f"headers {dups} appear more than once (case-insensitively)")
    targets: dict[str, str] = {}
    for name in columns:
        new = header_map.get(name, name)
        if new in targets:
            raise DuplicateHeaderError(f"headers {targets[new]!r} and {name!r} both map to {new!r}")
        targets[new] = name
    return list(targets)


def rename_columns(df: DataFrame, header_map: Mapping[str, str] = HEADER_MAP) -> DataFrame:
    """Map header spellings to canonical names (``canonical_names``)."""
    names = canonical_names(df.columns, header_map)
    return df.select(*[column(old).alias(new) for old, new in zip(df.columns, names)])


@dataclass
class Projection:
    frame: DataFrame
    missing: list[str] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)
    found: bool = True
    #: For a folder read file by file: (file, header, missing, dropped) of each.
    files: DataFrame | None = None


def project_existing_report(df: DataFrame, columns: Iterable[str]) -> Projection:
    """Keep ``columns`` that exist, in ``columns`` order; report the rest."""
    wanted = list(columns)
    present = set(df.columns)
    keep = [c for c in wanted if c in present]
    return Projection(
        frame=df.select(*[column(c) for c in keep]),
        missing=[c for c in wanted if c not in present],
        dropped=[c for c in df.columns if c not in set(wanted)],
    )


def project_existing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return project_existing_report(df, columns).frame


def normalize_na(df: DataFrame, tokens: Iterable[str] = NA_TOKENS,
                 columns: Iterable[str] | None = None) -> DataFrame:
    """Turn exact NA tokens into NULL in string columns (all of them by default)."""
    tokens = tuple(tokens)
    if not tokens:
        return df
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = strings if columns is None else set(columns) & strings
    return df.select(*[
        null_tokens(column(c), tokens).alias(c) if c in targets else column(c)
        for c in df.columns
    ])


def typed_cast(df: DataFrame, schema: T.StructType,
               observation: Observation | None = None) -> DataFrame:
    """Cast text columns to ``schema`` types without raising.

    Unparsable values become NULL.  With an ``Observation``, the number of
    rejected values per column is collected during the same pass
    (``rejected_<column>``), available after the first action.
    """
    typed = {f.name: f.dataType for f in schema.fields}
    cast_cols = [c for c in df.columns if c in typed and not isinstance(typed[c], T.StringType)]
    if observation is None or not cast_cols:
        return df.select(*[
            safe_cast(column(c), typed[c]).alias(c) if c in cast_cols else column(c)
            for c in df.columns
        ])
    raw = {c: f"__raw_{i}" for i, c in enumerate(cast_cols)}
    staged = df.select(
        *[column(c) for c in df.columns],
        *[column(c).alias(raw[c]) for c in cast_cols],
    ).select(
        *[safe_cast(column(c), typed[c]).alias(c) if c in cast_cols else column(c)
          for c in df.columns],
        *[F.col(raw[c]) for c in cast_cols],
    )
    metrics = [F.count_if(rejected(F.col(raw[c]), column(c))).alias(f"rejected_{c}")
               for c in cast_cols]
    return staged.observe(observation, *metrics).drop(*raw.values())


def align_to_schema(df: DataFrame, schema: T.StructType, keep: Iterable[str] = ()) -> DataFrame:
    """Exactly ``schema``'s columns, in order; absent ones as typed NULLs.

    The landing table keeps its full shape even when a file lacks a column,
    as a table created from DDL does.  Columns named in ``keep`` follow.
    """
    present = set(df.columns)
    return df.select(*[
        column(f.name).cast(f.dataType).alias(f.name) if f.name in present
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ], *[column(c) for c in keep])


def conform(df: DataFrame, schema: T.StructType, *, header_map: Mapping[str, str] = HEADER_MAP,
            na_tokens: Iterable[str] = NA_TOKENS,
            observation: Observation | None = None, keep: Iterable[str] = ()) -> Projection:
    """Rename -> project to ``schema`` -> NA tokens -> typed cast (one projection); ``keep`` columns stay as they are."""
    proj = project_existing_report(rename_columns(df, header_map), [*schema.fieldNames(), *keep])
    cleaned = normalize_na(proj.frame, na_tokens)
    proj.frame = typed_cast(cleaned, schema, observation)
    return proj

