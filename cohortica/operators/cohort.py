"""Cohort building: windowed lab pivot, first observation pivot, label flag, wide row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cohortica import fixed
from cohortica.functions import clean_number, ilike_any
from cohortica.operators.skew import grid_join, hot_keys, lookup_join, salted_join, salted_star


def filter_labels(dictionary: DataFrame, label: str, patterns: list[str],
                  category: str | None = None, category_pattern: str | None = None) -> DataFrame:
    """Dictionary rows whose label matches any pattern (and whose category matches its own)."""
    keep = ilike_any(F.col(label), patterns)
    if category is not None:
        keep = F.col(category).ilike(category_pattern) & keep
    return dictionary.where(keep)


def events_in_window(events: DataFrame, anchors: DataFrame, key: str, event_time: str,
                     anchor_time: str, hours: int, **probe_args) -> DataFrame:
    """Events from the anchor time to `hours` later, both ends included, per key.

    One equi-join with the time range as its residual. A small anchor table is broadcast, so
    events do not move; otherwise keys with very many events are salted.
    """
    window = F.make_interval(hours=F.lit(hours))
    joined = lookup_join(events, anchors.select(key, anchor_time), key, "inner", **probe_args)
    return joined.where(F.col(event_time).between(F.col(anchor_time), F.col(anchor_time) + window))


def windowed_pivot(events: DataFrame, dictionary: DataFrame, anchors: DataFrame, *, item: str,
                   key: str, event_time: str, anchor_time: str, hours: int, label: str,
                   value: str, measures: dict[str, str], **probe_args) -> DataFrame:
    """Per key, the maximum value of each labelled measure within the window.

    A key whose events all carry other labels of the dictionary keeps a row of NULLs.
    """
    labelled = lookup_join(events.select(key, item, event_time, value),
                           dictionary.select(item, label), item, "inner")
    near = events_in_window(labelled, anchors, key, event_time, anchor_time, hours, **probe_args)
    return near.groupBy(key).agg(
        *[F.max(F.when(F.col(label) == text, F.col(value))).alias(name)
          for name, text in measures.items()])


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key. The limit of one is applied before the shuffle as well."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def first_value_pivot(observations: DataFrame, *, entity: str, name: str, value: str, when: str,
                      tie_break: str, measures: dict[str, str], text_measures=()) -> DataFrame:
    """Per entity, the earliest value of each observation name, pivoted by name pattern.

    Numbers are parsed before MAX, text measures keep text MAX; `tie_break` settles equal dates.
    """
    first = first_rows(observations.select(entity, name, value, when, tie_break),
                       [entity, name], [when, tie_break])
    def picked(column, pattern):
        parsed = F.col(value) if column in text_measures else clean_number(F.col(value))
        return F.max(F.when(F.col(name).ilike(pattern), parsed)).alias(column)
    return first.groupBy(entity).agg(*[picked(c, p) for c, p in measures.items()])


def code_matches(codes: DataFrame, *, columns: list[str], code: str, patterns: list[str]) -> DataFrame:
    """Distinct rows of `columns` among the records whose code matches."""
    return codes.where(ilike_any(F.col(code), patterns)).select(*columns).distinct()


def code_hits(codes: DataFrame, *, key: str, code: str, patterns: list[str], flag: str,
              dedupe: bool = True, distinct_on: list[str] | None = None) -> DataFrame:
    """(key, 1) once per key with a matching code, or once per distinct `distinct_on` (key and code) of it."""
    columns = [key] if dedupe else distinct_on or [key, code]
    return code_matches(codes, columns=columns, code=code, patterns=patterns).select(key, F.lit(1).alias(flag))


def flag_label(anchors: DataFrame, codes: DataFrame, *, key: str, code: str, patterns: list[str],
               flag: str, dedupe: bool = True, **probe_args) -> DataFrame:
    """Add a 0/1 flag: does the key have a matching code?

    With `dedupe=False` the row repeats once per distinct matching code of the key.
    """
    hits = code_hits(codes, key=key, code=code, patterns=patterns, flag=flag, dedupe=dedupe)
    joined = salted_join if dedupe else grid_join  # a key has one hit, or as many as it has codes
    return joined(anchors, hits, key, "left", **probe_args).withColumn(flag, F.coalesce(flag, F.lit(0)))


def nutrition_labs(d_labitems: DataFrame) -> DataFrame:
    return filter_labels(d_labitems, "label", fixed.LAB_LABEL_PATTERNS, "fluid", fixed.LAB_FLUID)


def nutrition_lab_events(labevents: DataFrame, d_labitems: DataFrame, admissions: DataFrame) -> DataFrame:
    return windowed_pivot(
        labevents, nutrition_labs(d_labitems), admissions, item="itemid", key="hadm_id",
        event_time="charttime", anchor_time="admittime", hours=fixed.LAB_WINDOW_HOURS,
        label="label", value="valuenum", measures=fixed.LAB_MEASURES)


def first_observations(omr: DataFrame, tie_break: str = "seq") -> DataFrame:
    return first_value_pivot(
        omr, entity="subject_id", name="result_name", value="result_value", when="chartdate",
        tie_break=tie_break, measures=fixed.OBSERVATION_MEASURES,
        text_measures=fixed.OBSERVATION_TEXT_MEASURES)


def build_cohort(tables: dict[str, DataFrame], dedupe: bool = True, **probe_args) -> DataFrame:
    """One wide row per admission from the six clinical tables (29 columns).

    The subject-level tables join in one salted pass over the admissions and the admission-level
    ones, aggregated to one row per admission, in a second. Hot keys are looked up on the
    admissions themselves. Without `dedupe` an admission has as many rows as codes, so its codes may be hot
    as well and meet it in a grid.
    """
    admissions = tables["admissions"]
    base = admissions.select("subject_id", "hadm_id", "admission_type", "admission_location",
                             "marital_status", "race")
    patients = tables["patients"].select("subject_id", "gender", F.col("anchor_age").alias("age"))
    observed = first_observations(tables["omr"]).withColumn("subject_id:1", F.col("subject_id"))
    labs = nutrition_lab_events(tables["labevents"], tables["d_labitems"], admissions)
    labs = labs.withColumn("hadm_id:1", F.col("hadm_id"))
    hits = code_hits(tables["diagnoses_icd"], key="hadm_id", code="icd_code",
                     patterns=fixed.LABEL_CODE_PATTERNS, flag=fixed.LABEL_COLUMN, dedupe=dedupe,
                     distinct_on=["subject_id", "hadm_id", "icd_code"])
    wide = salted_star(base, [patients, observed], "subject_id", hot=hot_keys(base, "subject_id", **probe_args))
    hot = hot_keys(base, "hadm_id", **probe_args)
    if dedupe:
        wide = salted_star(wide, [labs, hits], "hadm_id", hot=hot)
    else:
        wide = grid_join(salted_star(wide, [labs], "hadm_id", hot=hot), hits, "hadm_id", hot=hot, **probe_args)
    wide = wide.withColumn(fixed.LABEL_COLUMN, F.coalesce(fixed.LABEL_COLUMN, F.lit(0)))
    return wide.select(
        "subject_id", "hadm_id", "gender", "age", "admission_type", "admission_location",
        "marital_status", "race", "`hadm_id:1`", *fixed.LAB_MEASURES, "`subject_id:1`",
        *fixed.OBSERVATION_MEASURES, fixed.LABEL_COLUMN)
