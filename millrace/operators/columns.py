"""Projection, filter and derived-column operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.sums import exact_avg

# Weather code ranges (inclusive) and their labels.
WEATHER_LABELS = (
    (0, 0, "Cerah"),
    (1, 3, "Sebagian Berawan"),
    (45, 48, "Kabut"),
    (51, 55, "Gerimis"),
    (61, 65, "Hujan"),
    (80, 82, "Hujan"),
    (71, 75, "Salju"),
    (85, 86, "Salju"),
    (95, 99, "Badai Petir"),
)
WEATHER_UNKNOWN = "Kondisi Tidak Diketahui"


def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The wanted columns that the table really has, in the wanted order."""
    return df.select(*[c for c in cols if c in df.columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep only the mapped columns under their new names."""
    return df.select(*[F.col(old).alias(new) for old, new in mapping.items()])


def first_band(value: Column, uppers: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first band whose exclusive upper bound is above the value."""
    out = F
    for upper, label in uppers:
        out = out.when(value < upper, label)
    return out.otherwise(F.when(value.isNotNull(), otherwise))


def cut(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edge, next edge]``; values outside every bin are NULL."""
    out = F
    for lo, hi, label in zip(edges, edges[1:], labels):
        out = out.when((value > lo) & (value <= hi), label)
    return out


def decade(value: Column) -> Column:
    return (F.floor(value / 10) * 10).cast("int")


def weather_label(code: Column) -> Column:
    out = F
    for lo, hi, label in WEATHER_LABELS:
        out = out.when(code.between(lo, hi), label)
    return out.otherwise(WEATHER_UNKNOWN)


def letter_grade(score: Column) -> Column:
    return (F.when(score >= 90, "A").when(score >= 80, "B").when(score >= 70, "C")
            .when(score >= 60, "D").otherwise("F"))


def user_status(created: Column, as_of: date, days: int = 30) -> Column:
    """New when created within ``days`` of ``as_of``, else Existing."""
    return F.when(created >= F.date_sub(F.lit(as_of), days), "New").otherwise("Existing")


def safe_cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; text that does not parse becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def impute_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def impute_mean(df: DataFrame, col: str) -> DataFrame:
    """Replace NULL by the column mean, computed once as a scalar subquery; it does not depend on task order."""
    mean = df.agg(exact_avg(col).alias("_mean")).scalar()
    return df.withColumn(col, F.coalesce(F.col(col).cast("double"), mean))


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row table on every row, as scalar subqueries."""
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])


def null_if_outside(value: Column, low=None, high=None) -> Column:
    ok = F.lit(True)
    if low is not None:
        ok = ok & (value >= low)
    if high is not None:
        ok = ok & (value <= high)
    return F.when(ok, value)


def discounted(price: Column, percent: Column) -> Column:
    return price * (1 - percent / 100)


def celsius_to_fahrenheit(c: Column) -> Column:
    return c * 9 / 5 + 32


def add_lineage(df: DataFrame, batch_id: str, version: str = "1.0.0", source: str | None = None,
                processed_at: Column | None = None) -> DataFrame:
    """Stamp batch id, version, source name and processing time (fixed per query)."""
    return df.withColumns({
        "batch_id": F.lit(batch_id),
        "pipeline_version": F.lit(version),
        "source_name": F.lit(source),
        "processed_at": F.current_timestamp() if processed_at is None else processed_at,
    })


def derive_date_parts(df: DataFrame, col: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Parse a text date in place and add year and month."""
    parsed = F.to_date(F.try_to_timestamp(F.col(col), F.lit(fmt)))
    return df.withColumn(col, parsed).withColumns({"year": F.year(col), "month": F.month(col)})


def event_pattern(pattern: Mapping, prefix: str = "") -> Column:
    """One boolean expression for a declarative event pattern.

    Fields are AND-ed; entries of a list are OR-ed; the conditions inside one entry
    (``prefix``, ``suffix``, ``numeric``) are AND-ed. Nested mappings address struct fields.
    """
    out = F.lit(True)
    for field, want in pattern.items():
        path = f"{prefix}.{field}" if prefix else field
        if isinstance(want, Mapping):
            out = out & event_pattern(want, path)
            continue
        quoted = F.col(".".join(f"`{p}`" for p in path.split(".")))
        any_of = F.lit(False)
        for entry in want:
            any_of = any_of | _pattern_entry(quoted, entry)
        out = out & F.coalesce(any_of, F.lit(False))
    return out


def _pattern_entry(value: Column, entry) -> Column:
    if not isinstance(entry, Mapping):
        return value == F.lit(entry) if entry is not None else value.isNull()
    ok = F.lit(True)
    for kind, arg in entry.items():
        if kind == "prefix":
            ok = ok & value.startswith(arg)
        elif kind == "suffix":
            ok = ok & value.endswith(arg)
        elif kind == "numeric":
            for op, bound in zip(arg[::2], arg[1::2]):
                ok = ok & {
                    ">": value > bound, ">=": value >= bound, "<": value < bound,
                    "<=": value <= bound, "=": value == bound,
                }[op]
        else:
            raise ValueError(f"unknown pattern condition: {kind}")
    return ok


def sample_rows(df: DataFrame, fraction: float, seed: int, keys: Sequence[str] | None = None) -> DataFrame:
    """About that share of the rows.

    With ``keys`` the digest of seed and keys decides, so that a row is in or out whatever the files and partitions; without,
    the choice follows the partitions. A row with a NULL key is decided by its other keys.
    """
    if keys is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    digest = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), 1, 8)
    bound = round(fraction * 16 ** 8)
    return df if bound >= 16 ** 8 else df.where(digest < f"{bound:08x}")


def hash_id(value: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)


def mask_email(value: Column) -> Column:
    """Keep the first character of the local part and the domain."""
    return F.regexp_replace(value, r"^(.)[^@]*@", "$1***@")


def redact_phone(value: Column) -> Column:
    """Replace the digits, keeping the last two characters."""
    head = F.regexp_replace(F.substring(value, F.lit(1), F.length(value) - 2), "[0-9]", "*")
    return F.concat(head, F.right(value, F.lit(2)))


MASKS = {"email": mask_email, "phone": redact_phone}


def mask_pii(df: DataFrame, rules: Mapping[str, str], salt: str = "") -> DataFrame:
    """Apply one rule per column: ``hash``, ``email`` or ``phone``."""
    return df.withColumns({
        c: hash_id(F.col(c), salt) if rule == "hash" else MASKS[rule](F.col(c)) for c, rule in rules.items()
    })
