"""Sample metadata put into regular form: column expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cellgrain.model import first_of, hash_int

#: Patterns of patient ids, in order.
PATIENT = (r"[Pp]atient[_-]?(\d+)", r"[Pp](\d+)", r"[Mm][Mm]_?(\d+)", r"[Pp][Mm]_?(\d+)")


def study_id(df: DataFrame, key: str | None = None, dataset: str | None = None) -> Column:
    """The key's value on each row, else the dataset's name, else ``unknown``."""
    column = F.col(key) if key and key in df.columns else F.lit(None).cast("string")
    return F.coalesce(column, F.lit(dataset), F.lit("unknown"))


def first_study(df: DataFrame, key: str, order: str, dataset: str | None = None) -> DataFrame:
    """One row: the key's first value in the order of a column (nulls left out), else the dataset's name, else ``unknown``."""
    first = F.min_by(key, F.when(F.col(key).isNotNull(), F.col(order)))
    return df.agg(F.coalesce(first, F.lit(dataset), F.lit("unknown")).alias("study_id"))


def patient_id(name: Column) -> Column:
    """The whole match of the first pattern that fits; else ``unknown_`` and a number from the name's digest."""
    found = [F.nullif(F.regexp_extract(name, p, 0), F.lit("")) for p in PATIENT]
    return F.coalesce(*found, F.concat(F.lit("unknown_"), (hash_int(F.coalesce(name, F.lit(""))) % 1000).cast("string")))


def sample_type(status: Column, strict_order: bool = False) -> Column:
    """By substrings of the lower-case status. As in published results ``mm`` is looked for first, so that ``smm`` and
    ``smoldering myeloma`` are MM; ``strict_order`` looks for the smouldering forms first."""
    s = F.lower(F.coalesce(status, F.lit("")))
    has = lambda *words: reduce(lambda a, b: a | b, (s.contains(w) for w in words))
    rules = [("MM", has("mm", "multiple myeloma", "myeloma")), ("SMM", has("smm", "smoldering")), ("MGUS", has("mgus")), ("healthy", has("normal", "healthy", "control", "donor"))]
    if strict_order:
        rules = [rules[1], rules[2], rules[0], rules[3]]
    out = F.when(rules[0][1], rules[0][0])
    for name, condition in rules[1:]:
        out = out.when(condition, name)
    return out.otherwise("unknown")


def tissue(value: Column) -> Column:
    """Lower case, spaces and hyphens as underscores; ``bone_marrow`` where unknown."""
    return F.translate(F.lower(F.coalesce(value, F.lit("bone_marrow"))), " -", "__")


def technology(value: Column) -> Column:
    """Lower case; 10x and smartseq spelled out, also inside of longer names."""
    return F.replace(F.replace(F.lower(F.coalesce(value, F.lit("unknown"))), F.lit("10x"), F.lit("10x_genomics")), F.lit("smartseq"), F.lit("smart_seq"))


def characteristics(parts: Column) -> Column:
    return F.concat_ws(" | ", parts)


def annotate(cells: DataFrame, name: str | None = "sample_title", status: str | None = None, tissue_column: str | None = None, technology_column: str | None = None, dataset: str | None = None) -> DataFrame:
    """Adds study_id, patient_id, sample_type, tissue and technology. Columns are found when the plan is made, each by
    its fallbacks; without one the default stands."""
    none = F.lit(None).cast("string")
    pick = lambda *names: F.col(c).cast("string") if (c := first_of(cells, *names)) else none
    return cells.withColumns(
        {
            "study_id": study_id(cells, "study_id" if "study_id" in cells.columns else None, dataset),
            "patient_id": patient_id(pick(name)) if first_of(cells, name) else F.lit("unknown"),
            "sample_type": sample_type(pick(status, "disease_state", "condition")),
            "tissue": tissue(pick(tissue_column, "tissue", "source_tissue", "tissue_type")),
            "technology": technology(pick(technology_column, "technology", "sequencing_technology", "platform")),
        }
    )


def parsed_time(text: Column) -> Column:
    """Microseconds of a timestamp, or the number that the text is."""
    return F.coalesce(F.unix_micros(F.try_to_timestamp(text)).cast("double"), F.try_cast(text, "double") if hasattr(F, "try_cast") else text.try_cast("double"))
