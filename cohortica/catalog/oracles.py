"""The same results in plain SQL over the same tables, written independently of the library."""

from __future__ import annotations

from cohortica import fixed
from cohortica.catalog.clinical import clinical_sql

_GAPS = ("lines as (select l_returnflag, l_linestatus, l_quantity, nullif(l_discount, 0) as l_discount, "
         "nullif(l_tax, 0) as l_tax from lineitem)")
_MODEL_COLUMNS = fixed.FEATURES_TO_USE
_DOUBLES = {"height_cm", "weight_kg", "bmi", "glucose_admit", "hematocrit_admit", "hemoglobin_admit",
            "potassium_admit", "systolic", "diastolic"}
_ROUNDED = ", ".join(f"round({c}, 4) as {c}" if c in _DOUBLES else c for c in _MODEL_COLUMNS)

ORACLES: dict[str, str] = {}

# --- cohort
ORACLES["dim_like_filter"] = "select * from part where p_name ilike 'small%' or p_name ilike '%ring'"
ORACLES["dim_like_filter_category"] = (
    "select * from part where p_type ilike 'promo' and (p_name ilike '%e%' or p_name ilike 'r_ng')")
ORACLES["events_in_window"] = """
select l_orderkey, l_linenumber, l_partkey, l_shipdate, o_orderdate
from lineitem join orders on l_orderkey = o_orderkey
where l_shipdate between o_orderdate and o_orderdate + interval 8760 hours"""
_PRICES = ", ".join(f"max(case when p_type = '{t}' then l_extendedprice end) as {n}" for n, t in [
    ("promo_price", "PROMO"), ("small_price", "SMALL"), ("economy_price", "ECONOMY"),
    ("standard_price", "STANDARD"), ("large_price", "LARGE")])
ORACLES["cohort_pivot"] = f"""
select l_orderkey, {_PRICES} from lineitem
join (select p_partkey, p_type from part where p_name ilike 'small%' or p_name ilike '%ring') on l_partkey = p_partkey
join orders on l_orderkey = o_orderkey
where l_shipdate between o_orderdate and o_orderdate + interval 8760 hours group by l_orderkey"""
ORACLES["first_observation_pivot"] = """
with ranked as (select o_custkey, o_orderpriority, cast(cast(floor(o_totalprice) as bigint) as varchar) as paid,
  row_number() over (partition by o_custkey, o_orderpriority order by o_orderdate nulls first, o_orderkey) as rn from orders)
select o_custkey, max(case when o_orderpriority ilike '%urgent%' then cast(paid as double) end) as urgent,
  max(case when o_orderpriority ilike '%high%' then cast(paid as double) end) as high,
  max(case when o_orderpriority ilike '%low' then cast(paid as double) end) as low,
  max(case when o_orderpriority ilike '3-%' then paid end) as medium_text
from ranked where rn = 1 group by o_custkey"""
ORACLES["label_flag"] = """
select o_orderkey, o_orderstatus, case when o_orderkey in (select l_orderkey from lineitem
  where l_returnflag in ('A', 'R')) then 1 else 0 end as returned from orders"""
ORACLES["label_fanout"] = """
select o_orderkey, o_orderstatus, case when code is not null then 1 else 0 end as returned from orders
left join (select distinct l_orderkey, l_returnflag || l_linestatus as code from lineitem
  where l_returnflag in ('A', 'R')) on o_orderkey = l_orderkey"""
ORACLES["nutrition_labs"] = clinical_sql("select itemid, label, fluid from d_nutrition_labs")
ORACLES["nutrition_lab_events"] = clinical_sql("select * from nutrition_lab_events")
ORACLES["first_patient_observations"] = clinical_sql("select * from omr_admit_antho")
ORACLES["cohort_wide"] = clinical_sql("select * from cohort")
ORACLES["cohort_wide_fanout"] = clinical_sql(
    "select c.* from cohort c left join coded k on c.hadm_id = k.hadm_id")

# --- cleaning and features
ORACLES["clean_features"] = clinical_sql(f"select hadm_id, {_ROUNDED} from cleaned")
ORACLES["group_categories"] = clinical_sql(
    "select hadm_id, race_grouped, admit_type_grouped, admit_loc_grouped from grouped")
ORACLES["group_texts"] = """
with t as (select doc_id, upper(text) as u, source from documents)
select doc_id,
  case when contains(u, 'HISPANIC') or contains(u, 'LATINO') then 'hispanic' when starts_with(u, 'BLACK') then 'black'
    when starts_with(u, 'WHITE') or u = 'PORTUGUESE' then 'white'
    when u in ('UNKNOWN', 'UNABLE TO OBTAIN', 'PATIENT DECLINED TO ANSWER') then 'unknown/declined' else 'other' end as race_grouped,
  case when contains(u, 'OBSERVATION') then 'observation' when contains(u, 'URGENT') then 'urgent_care'
    when contains(u, 'EMER') then 'emergency' when starts_with(u, 'ELECTIVE') then 'elective'
    when starts_with(u, 'SURGICAL') then 'surgical_admit' else 'other' end as admit_type_grouped,
  case when contains(u, 'NURSING') then 'snf'
    when contains(u, 'ROOM') or contains(u, 'PACU') or contains(u, 'SITE') or contains(u, 'PSYCH') then 'internal'
    when contains(u, 'HOSPITAL') then 'hospital' when starts_with(u, 'PHYSI') or starts_with(u, 'CLINIC') then 'referral'
    when starts_with(u, 'WALK') then 'walkin' else 'other_unknown' end as admit_loc_grouped,
  case when starts_with(source, 'src1') then 'teens' when source = 'src3' or contains(source, '7') then 'odd'
    else 'rest' end as source_grouped
from t"""
ORACLES["typed_text_columns"] = """
select o_orderkey, case when o_orderstatus = 'F' then floor(o_totalprice) end as price,
  case when o_orderpriority <> '5-LOW' then o_orderpriority end as priority,
  case when o_orderpriority <> '2-HIGH' then cast(substring(o_orderpriority, 1, 1) as int) end as level from orders"""
ORACLES["dummy_encode"] = """
select c_custkey, """ + ", ".join(
    f"case when c_mktsegment = '{s}' then 1.0::double else 0.0::double end as \"c_mktsegment_{s}\""
    for s in ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]) + " from customer"
ORACLES["scale_features"] = """
with s as (select avg(p_size) as m0, stddev_pop(p_size) as s0, avg(p_retailprice) as m1, stddev_pop(p_retailprice) as s1 from part)
select p_partkey, round((p_size - m0) / s0, 4) as p_size_z, round((p_retailprice - m1) / s1, 4) as p_retailprice_z,
  cast(p_size as double) as size_back from part, s"""


def _knn_sql(base: str, key: str, features: list[str], targets: list[str], final: str, k: int = 5) -> str:
    """Brute force: every receiver against every donor."""
    stats = ", ".join(f"avg({c}) as m{i}, stddev_pop({c}) as s{i}" for i, c in enumerate(features))
    zs = ", ".join(f"({c} - m{i}) / s{i} as z{i}" for i, c in enumerate(features))
    terms = [f"(r.z{i} - d.z{i}) * (r.z{i} - d.z{i})" for i in range(len(features))]
    total = " + ".join(f"coalesce({t}, 0)" for t in terms)
    shared = " + ".join(f"(case when r.z{i} is not null and d.z{i} is not null then 1 else 0 end)" for i in range(len(features)))
    parts = [f"base as ({base})", f"st as (select {stats} from base)", f"zed as (select base.*, {zs} from base, st)"]
    for t in targets:
        parts.append(f"""
near_{t} as (select rid, y, gap from (select r.{key} as rid, d.{key} as did, d.{t} as y,
  round(sqrt({total}) * sqrt({float(len(features))}::double / ({shared})), 9) as gap
  from zed r join zed d on r.{t} is null and d.{t} is not null where ({shared}) > 0)
  qualify row_number() over (partition by rid order by gap, did) <= {k})""")
        parts.append(f"""
new_{t} as (select rid, case when min(gap) = 0 then avg(case when gap = 0 then y end)
  else sum(y / nullif(gap, 0)) / sum(1 / nullif(gap, 0)) end as v from near_{t} group by rid)""")
    filled = ", ".join(f"coalesce(b.{t}, new_{t}.v, (select avg({t}) from base)) as {t}" for t in targets)
    joins = " ".join(f"left join new_{t} on b.{key} = new_{t}.rid" for t in targets)
    others = ", ".join(f"b.{c}" for c in [key, *features] if c not in targets)
    parts.append(f"filled as (select {others}, {filled} from base b {joins})")
    return ",\n".join(parts) + f"\n{final}"


ORACLES["knn_impute"] = "with " + _knn_sql(
    "select p_partkey, cast(p_size as double) as size, case when p_type <> 'PROMO' then p_retailprice end as price, "
    "case when p_brand <> 'Brand#7' then p_retailprice * 0.5::double + p_size end as cost from part",
    "p_partkey", ["size", "price", "cost"], ["price", "cost"],
    "select p_partkey, size, round(price, 3) as price, round(cost, 3) as cost from filled")
ORACLES["impute_patients"] = clinical_sql("").rstrip() + ",\n" + _knn_sql(
    "select p.subject_id, p.anchor_age as age, o.height_in * 2.54::double as height_cm, o.weight_lb / 2.2::double as weight_kg, "
    "case when p.gender = 'M' then 1.0::double else 0.0::double end as is_male from patients p "
    "left join omr_admit_antho o on p.subject_id = o.subject_id",
    "subject_id", ["age", "height_cm", "weight_kg", "is_male"], ["height_cm", "weight_kg"],
    "select subject_id, round(height_cm, 3) as height_cm, round(weight_kg, 3) as weight_kg, "
    "round(weight_kg / ((height_cm / 100) * (height_cm / 100)), 3) as bmi from filled")

# --- quality
ORACLES["quality_report"] = f"""
with {_GAPS}
select count(*) as total_rows, count(*) * 5 - count(l_returnflag) - count(l_linestatus) - count(l_quantity) - count(l_discount) - count(l_tax) as total_nulls,
  round((count(*) * 5 - count(l_returnflag) - count(l_linestatus) - count(l_quantity) - count(l_discount) - count(l_tax)) * 100.0::double / (count(*) * 5), 2) as null_percentage,
  count(*) - (select count(*) from (select distinct * from lines)) as duplicate_rows,
  min(l_quantity) as l_quantity_min, max(l_quantity) as l_quantity_max, min(l_discount) as l_discount_min, max(l_discount) as l_discount_max
from lines"""
_CLEAN_ALL = ["gender", "age", "admission_type", "admission_location", "marital_status", "race",
              "alkaline_phosphatase_admit", "asparate_aminotransferase_ast_admit", "c_reactive_protein_admit",
              "glucose_admit", "hematocrit_admit", "hemoglobin_admit", "magnesium_admit", "phosphate_admit",
              "potassium_admit", "bmi", "has_malnutrition", "systolic", "diastolic", "weight_kg", "height_cm",
              "alk_phos_ordered", "ast_ordered"]
_CLEAN_SELECT = ", ".join(("b." if c in ("alkaline_phosphatase_admit", "asparate_aminotransferase_ast_admit",
                                         "c_reactive_protein_admit", "magnesium_admit", "phosphate_admit") else "a.") + c
                          for c in _CLEAN_ALL)
_NULLS = " + ".join(f"count(*) - count({c})" for c in _CLEAN_ALL)
ORACLES["cohort_quality"] = clinical_sql("").rstrip() + f""",
f as (select {_CLEAN_SELECT} from cleaned a join cohort b on a.hadm_id = b.hadm_id)
select count(*) as total_rows, {_NULLS} as total_nulls, round(({_NULLS}) * 100.0::double / (count(*) * {len(_CLEAN_ALL)}), 2) as null_percentage,
  count(*) - (select count(*) from (select distinct * from f)) as duplicate_rows,
  cast(min(age) as double) as age_min, cast(max(age) as double) as age_max, round(min(bmi), 4) as bmi_min, round(max(bmi), 4) as bmi_max,
  round(min(glucose_admit), 4) as glucose_admit_min, round(max(glucose_admit), 4) as glucose_admit_max from f"""
ORACLES["column_ranges"] = " union all ".join(
    f"select '{c}' as column_name, min({c}) as min_value, max({c}) as max_value from lineitem"
    for c in ["l_quantity", "l_extendedprice", "l_tax"])


def _describe(source: str, columns: dict[str, str], digits: int) -> str:
    r = lambda e: f"round({e}, {digits})"
    return " union all ".join(
        f"select '{n}' as feature, count({e}) as n, {r(f'avg({e})')} as mean, {r(f'stddev_samp({e})')} as std, "
        f"{r(f'min({e})')} as min_value, {r(f'quantile_cont({e}, 0.25)')} as q25, {r(f'quantile_cont({e}, 0.5)')} as q50, "
        f"{r(f'quantile_cont({e}, 0.75)')} as q75, {r(f'max({e})')} as max_value from {source}" for n, e in columns.items())


ORACLES["describe_numeric"] = f"with {_GAPS} " + _describe(
    "lines", {"l_quantity": "l_quantity", "l_discount": "l_discount", "l_tax": "l_tax", "l_half": "(l_quantity / 2)"}, 4)
ORACLES["describe_prices"] = _describe("lineitem", {"l_extendedprice": "l_extendedprice"}, 2)
ORACLES["structure_summary"] = f"with {_GAPS} " + " union all ".join(
    f"select '{c}' as column_name, '{t}' as data_type, count({c}) as non_null, count(*) as total_rows from lines"
    for c, t in [("l_returnflag", "string"), ("l_linestatus", "string"), ("l_quantity", "double"),
                 ("l_discount", "double"), ("l_tax", "double")])


def _ranges(source: str, rules: list[tuple]) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, {lo}::double as low, {hi}::double as high, "
        f"count(*) filter (where {c} < {lo} or {c} > {hi}{'' if ok else f' or {c} is null'}) as violations from {source}"
        for c, lo, hi, ok in rules)


ORACLES["range_violations"] = clinical_sql("select * from (" + _ranges("cleaned", [
    ("age", 18, 99, False), ("height_cm", 120, 210, False), ("weight_kg", 30, 300, False), ("bmi", 10, 80, False),
    ("glucose_admit", 20, 2000, True), ("hematocrit_admit", 3, 70, True), ("hemoglobin_admit", 1.5, 23, True),
    ("potassium_admit", 1.0, 10.0, True), ("systolic", 40, 280, True), ("diastolic", 15, 180, True),
    ("alk_phos_ordered", 0, 1, True), ("ast_ordered", 0, 1, True)]) + ") where violations > 0")
ORACLES["range_check"] = f"with {_GAPS} " + _ranges("lines", [
    ("l_quantity", 2, 49, False), ("l_discount", 0.02, 0.08, True), ("l_tax", 0.0, 0.07, False)])
ORACLES["domain_violations"] = clinical_sql("""
select column_name, value, count(*) as n from (
  select 'marital_status' as column_name,
    case when admission_type = 'URGENT' then 'PARTNERED' else marital_status end as value from grouped
  union all select 'gender', gender from grouped
  union all select 'has_malnutrition', cast(has_malnutrition as varchar) from grouped
  union all select 'race_grouped', race_grouped from grouped
  union all select 'admit_type_grouped', admit_type_grouped from grouped
  union all select 'admit_loc_grouped', admit_loc_grouped from grouped)
where value is null or value not in ('0', '1', 'M', 'F', 'SINGLE', 'MARRIED', 'DIVORCED', 'WIDOWED', 'UNKNOWN', 'hispanic',
  'black', 'white', 'unknown/declined', 'other', 'observation', 'urgent_care', 'emergency', 'elective', 'surgical_admit',
  'snf', 'internal', 'hospital', 'referral', 'walkin', 'other_unknown') group by column_name, value""")
ORACLES["unexpected_values"] = """
select p_brand from part except select p_brand from part where p_retailprice < 900.5"""
ORACLES["distinct_values"] = "select distinct o_orderstatus, o_orderpriority from orders"
ORACLES["count_matching"] = f"""
with {_GAPS} select count(*) filter (where l_discount is not null and l_returnflag = 'R') as matching, count(*) as total from lines"""
ORACLES["filter_not_null"] = "select l_orderkey, l_linenumber, l_discount from lineitem where l_discount = 0.05::double"
ORACLES["top_rows"] = """
select o_orderkey, o_custkey, o_totalprice from orders order by o_totalprice desc nulls last, o_orderkey limit 10"""

ORACLES["head_rows"] = "select o_orderkey, o_custkey, o_orderdate from orders order by o_orderkey limit 5"
ORACLES["label_domain"] = """
select 'toxic' as column_name, cast(toxic as varchar) as value, count(*) as n from labels where toxic <> 0 group by toxic
union all select 'quality', cast(quality as varchar), count(*) from labels where quality not in (0, 1) group by quality"""

# --- splits and weights
_RANKED = """ranked as (select o_orderkey, o_orderstatus, count(*) over (partition by o_orderstatus) as n,
  row_number() over (partition by o_orderstatus order by md5(concat(cast(o_orderkey as varchar), ':42')), o_orderkey) as rn from orders)"""
ORACLES["stratified_split"] = f"with {_RANKED} select o_orderkey, o_orderstatus, rn <= round(n * 0.2::double) as is_test from ranked"
ORACLES["stratified_folds"] = f"with {_RANKED} select o_orderkey, o_orderstatus, cast((rn - 1) % 3 as int) as fold from ranked"
ORACLES["split_without_keys"] = f"""with {_RANKED}
select o_orderstatus, rn <= round(n * 0.2::double) as is_test, count(*) as n from ranked group by all"""
ORACLES["folds_without_keys"] = f"""with {_RANKED}
select o_orderstatus, cast((rn - 1) % 3 as int) as fold, count(*) as n from ranked group by all"""
ORACLES["class_weights"] = """
select l_returnflag, count(*) as n, round((select count(*) from lineitem) / ((select count(distinct l_returnflag) from lineitem) * count(*))::double, 4) as weight
from lineitem group by l_returnflag"""
ORACLES["row_weights"] = """
with c as (select quality, count(*) as n from labels group by quality)
select doc_id, l.quality, round((select sum(n) from c) / ((select count(*) from c) * n)::double * case when l.quality = 1 then 15 else 1 end, 4) as weight
from labels l join c on l.quality = c.quality"""

# --- metrics
_SCORED = """scored as (select l.quality as label, cast(n_chars as double) as score, case when n_chars > 1000 then 1 else 0 end as prediction
  from labels l join documents d on l.doc_id = d.doc_id)"""
_LINES = """scored as (select case when l_returnflag = 'R' then 1 else 0 end as label, l_extendedprice as score,
  case when l_quantity > 25 then 1 else 0 end as prediction from lineitem)"""
_AUC = """auc as (select (sum(case when label = 1 then mid end) - max(p) * (max(p) + 1) / 2.0::double) / (max(p) * max(q)::double) as v from (
  select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0::double as mid,
  count(*) filter (where label = 1) over () as p, count(*) filter (where label <> 1) over () as q from scored))"""
ORACLES["confusion_matrix"] = f"with {_LINES} select label, prediction, count(*) as n from scored group by label, prediction"
ORACLES["class_report"] = f"""
with {_SCORED}, per as (select c as class, count(*) filter (where label = c) as support,
    coalesce(count(*) filter (where label = c and prediction = c) / nullif(count(*) filter (where prediction = c), 0)::double, 0) as precision,
    coalesce(count(*) filter (where label = c and prediction = c) / nullif(count(*) filter (where label = c), 0)::double, 0) as recall
  from scored, (select distinct label as c from scored union select distinct prediction from scored) group by c),
f as (select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1_score from per),
a as (select count(*) filter (where label = prediction) / count(*)::double as v, count(*) as n from scored)
select cast(class as varchar) as class, round(precision, 4) as precision, round(recall, 4) as recall, round(f1_score, 4) as f1_score, support from f
union all select 'accuracy', round(v, 4), round(v, 4), round(v, 4), n from a
union all select 'macro avg', round(avg(precision), 4), round(avg(recall), 4), round(avg(f1_score), 4), cast(sum(support) as bigint) from f
union all select 'weighted avg', round(sum(precision * support) / sum(support), 4), round(sum(recall * support) / sum(support), 4),
  round(sum(f1_score * support) / sum(support), 4), cast(sum(support) as bigint) from f"""
ORACLES["roc_auc"] = f"with {_SCORED}, {_AUC} select round(v, 4) as roc_auc from auc"
ORACLES["roc_auc_lines"] = f"with {_LINES}, {_AUC} select round(v, 4) as roc_auc from auc"
ORACLES["threshold_sweep"] = f"""
with {_SCORED}, cuts as (select score as threshold, cast(sum(sum(case when label = 1 then 1 else 0 end)) over (order by score desc) as bigint) as tp,
    cast(sum(sum(case when label = 1 then 0 else 1 end)) over (order by score desc) as bigint) as fp from scored group by score),
m as (select *, tp / (tp + fp)::double as p, coalesce(tp / nullif((select count(*) from scored where label = 1), 0)::double, 0) as r from cuts)
select threshold, tp, fp, round(p, 4) as precision, round(r, 4) as recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 4) as f1_score from m"""
_BINARY = f"""{_LINES}, {_AUC},
c as (select count(*) filter (where label = 1 and prediction = 1)::double as tp, count(*) filter (where prediction = 1) as said,
  count(*) filter (where label = 1) as pos, count(*) filter (where label = prediction)::double as ok, count(*) as n from scored),
pr as (select ok / n as accuracy, coalesce(tp / nullif(said, 0), 0) as precision, coalesce(tp / nullif(pos, 0), 0) as recall from c),
m as (select round(accuracy, 4) as accuracy, round(precision, 4) as precision, round(recall, 4) as recall,
  round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 4) as f1_score,
  round((select v from auc), 4) as roc_auc from pr)"""
ORACLES["binary_metrics"] = f"with {_BINARY} select * from m"
ORACLES["quality_gate"] = f"""
with {_BINARY} select * from (select 'accuracy' as metric, accuracy as value, 0.35::double as minimum from m
  union all select 'f1_score', f1_score, 0.5::double from m) where value < minimum"""

# --- drift
_PERIODS = "ev as (select *, ts < timestamp '2024-01-16 00:00:00' as is_ref from events)"


def _counts(name: str, columns: list[str], source: str = "ev", kind: str = "double") -> str:
    cells = " union all ".join(f"select '{c}' as feature, cast({c} as {kind}) as value, is_ref from {source}" for c in columns)
    return (f"{name} as (select feature, value, count(*) filter (where is_ref) as a, count(*) filter (where not is_ref) as b "
            f"from ({cells}) where value is not null group by feature, value)")


_CDF = """cdf as (select *, sum(a) over (partition by feature) as ta, sum(b) over (partition by feature) as tb,
  abs(sum(a) over w / sum(a) over (partition by feature)::double - sum(b) over w / sum(b) over (partition by feature)::double) as gap,
  lead(value) over w - value as width from num window w as (partition by feature order by value))"""
_DEVIATION = """dev as (select feature, sqrt(sum(a * (value - c) * (value - c)) / sum(a)) as s from num
  join (select feature as f, sum(a * value) / sum(a) as c from num group by feature) on feature = f group by feature)"""
_W1 = f"""{_CDF}, {_DEVIATION}, w1 as (select cdf.feature, coalesce(sum(gap * width), 0) / greatest(max(s), 0.001::double) as distance
  from cdf join dev on cdf.feature = dev.feature group by cdf.feature)"""
_KS = """ksd as (select feature, max(gap) as distance, max(ta)::double as ta, max(tb)::double as tb from cdf group by feature),
ks as (select feature, max(distance) as distance, case when max(-2 * distance * distance * ta * tb / (ta + tb)) > -0.08 then 1.0::double
  else least(1, greatest(0, 2 * sum((case when j % 2 = 1 then 1 else -1 end) * exp(-2 * distance * distance * ta * tb / (ta + tb) * j * j)))) end as p_value
  from ksd, range(1, 2001) as r(j) group by feature)"""


def _js(counts: str) -> str:
    return f"""js as (select feature, sqrt(sum(0.5 * case when p > 0 then p * ln(p / ((p + q) / 2)) else 0 end
  + 0.5 * case when q > 0 then q * ln(q / ((p + q) / 2)) else 0 end)) as distance from (
  select feature, a / sum(a) over (partition by feature)::double as p, b / sum(b) over (partition by feature)::double as q from {counts}) group by feature)"""


ORACLES["drift_side_counts"] = f"with {_PERIODS}, {_counts('cat', ['event_type'], kind='varchar')} select * from cat"
_NUM = _counts("num", ["value", "user_id"])
ORACLES["drift_wasserstein"] = f"with {_PERIODS}, {_NUM}, {_W1} select feature, round(distance, 4) as distance from w1"
ORACLES["drift_ks"] = f"with {_PERIODS}, {_NUM}, {_CDF}, {_KS} select feature, round(distance, 4) as distance, round(p_value, 4) as p_value from ks"
_CAT = _counts("cat", ["event_type"], kind="varchar")
ORACLES["drift_js"] = f"with {_PERIODS}, {_CAT}, {_js('cat')} select feature, round(distance, 4) as distance from js"
ORACLES["drift_js_binned"] = f"""
with {_PERIODS}, s as (select min(value) as lo, max(value) as hi, cast(ceil(log2(count(value))) as int) + 1 as bins from ev),
bin as (select 'value' as feature, count(*) filter (where is_ref) as a, count(*) filter (where not is_ref) as b from ev, s
  group by least(floor((value - lo) / (hi - lo) * bins), bins - 1)), {_js('bin')}
select feature, round(distance, 4) as distance from js"""
_CHI = """chi as (select feature, coalesce(sum(case when a > 0 then (b - e) * (b - e) / e end), 0) as statistic,
  count(*) filter (where a > 0) - 1 as degrees, count(*) filter (where a = 0) as new_values
  from (select *, sum(b) over (partition by feature) * (a / sum(a) over (partition by feature)::double) as e from cat) group by feature)"""
ORACLES["drift_chi2_stat"] = f"with {_PERIODS}, {_CAT}, {_CHI} select feature, round(statistic, 4) as statistic, degrees, new_values from chi"
# Four degrees of freedom have a closed-form tail: exp(-x/2) * (1 + x/2).
ORACLES["drift_chi2"] = f"""with {_PERIODS}, {_CAT}, {_CHI} select feature, round(statistic, 4) as statistic, degrees, new_values,
  round(case when new_values > 0 then 0 else exp(-statistic / 2) * (1 + statistic / 2) end, 4) as p_value from chi"""
ORACLES["drift_prop_z"] = f"""
with {_PERIODS}, c as (select count(*) filter (where is_ref and event_type <> 'error')::double as x, count(*) filter (where is_ref)::double as n,
  count(*) filter (where not is_ref and event_type <> 'error')::double as y, count(*) filter (where not is_ref)::double as m from ev),
zs as (select (x / n - y / m) / sqrt((x + y) / (n + m) * (1 - (x + y) / (n + m)) * (1 / n + 1 / m)) as z from c),
t as (select z, least(abs(z), 6) / sqrt(2::double) as x from zs)
select 'is_error' as feature, round(z, 4) as z, round(greatest(0, 1 - 2 / sqrt(pi()) * list_sum(
  [pow(-1, i) * pow(x, 2 * i + 1) / (gamma(i + 1::double) * (2 * i + 1)) for i in range(0, 100)])), 4) as p_value from t"""
_FEATURES = f"""{_PERIODS}, {_NUM}, {_W1}, {_CAT}, {_js('cat')},
features as (select feature, 'wasserstein' as method, 0.1::double as threshold, round(distance, 4) as drift_score, distance >= 0.1 as drifted from w1
  union all select feature, 'jensen_shannon', 0.1::double, round(distance, 4), distance >= 0.1 from js)"""
ORACLES["drift_features"] = f"with {_FEATURES} select * from features"
ORACLES["drift_summary"] = f"""with {_FEATURES} select 'second half' as period, count(*) as total_features,
  count(*) filter (where drifted) as drifted_features, round(avg(case when drifted then 1 else 0 end), 3) as drift_share,
  avg(case when drifted then 1 else 0 end) >= 0.5 as dataset_drift from features"""
ORACLES["drift_features_small"] = f"""
with sup as (select s_acctbal, s_nationkey, s_name, s_nationkey < 12 as is_ref from supplier),
{_counts('num', ['s_acctbal', 's_nationkey'], 'sup')}, {_CDF}, {_KS},
{_counts('cat', ['s_name'], 'sup', 'varchar')}, {_CHI}
select feature, 'kolmogorov_smirnov' as method, 0.05::double as threshold, round(p_value, 4) as drift_score, p_value < 0.05 as drifted from ks
union all select feature, 'chi_square', 0.05::double, case when new_values > 0 then 0::double end, new_values > 0 from chi"""

# --- runs
_RUNS = """runs as (select cast(o_orderkey as varchar) as run_id,
  case when o_orderpriority = '1-URGENT' then cast(o_custkey as varchar) end as parent_run_id,
  case when o_totalprice < 450000 then o_totalprice / 500000 end as f1_score, o_totalprice / 600000 as recall,
  case when o_orderpriority = '5-LOW' then '-1' else '8' end as max_depth,
  case when o_orderpriority = '2-HIGH' then 'None' else 'balanced' end as class_weight, cast(o_custkey as varchar) as n_estimators,
  o_orderstatus from orders),
done as (select * from runs where o_orderstatus = 'F'),
kept as (select * from done where run_id not in (select parent_run_id from done where parent_run_id is not null)),
best as (select * from kept order by f1_score desc nulls last, run_id limit 1)"""


def _params(source: str) -> str:
    return f"""
select run_id, 'max_depth' as name, max_depth as value, cast(max_depth as bigint) as as_int, null::double as as_double, null::varchar as as_text from {source}
union all select run_id, 'learning_rate', '0.05', null, 0.05::double, null from {source}
union all select run_id, 'class_weight', class_weight, null, null, case when class_weight <> 'None' then class_weight end from {source}
union all select run_id, 'n_estimators', n_estimators, cast(n_estimators as bigint), null, null from {source}"""


ORACLES["finished_runs"] = f"with {_RUNS} select run_id, f1_score, recall from kept"
ORACLES["top_runs"] = f"""with {_RUNS} select run_id, f1_score, recall from kept
order by kept.f1_score desc nulls last, run_id limit 5"""
ORACLES["run_params"] = f"with {_RUNS} {_params('runs')}"
ORACLES["best_params"] = f"with {_RUNS} {_params('best')}"

# --- models: what holds for every model
_ORDERS = """frame as (select o_orderkey, o_custkey,
    case when o_orderkey in (select l_orderkey from lineitem where {flag}) then 1 else 0 end as label from orders),
  sided as (select label, row_number() over (partition by label order by md5(concat(cast(o_orderkey as varchar), ':42')), o_orderkey)
      <= round(count(*) over (partition by label) * 0.2::double) as is_test, o_orderkey from frame)""".replace(
    "{flag}", "l_returnflag ilike 'A%' or l_returnflag ilike 'R%'")
ORACLES["gbt_score_facts"] = f"""with {_ORDERS}
select label, is_test, count(*) as n, 0 as out_of_range, 0 as against_score from sided group by label, is_test"""
ORACLES["gbt_metric_facts"] = f"""with {_ORDERS}
select count(*) as n, true as accuracy, true as precision, true as recall, true as f1_score, true as roc_auc, true as better_than_chance
from sided where is_test"""
ORACLES["search_facts"] = f"""with {_ORDERS},
folded as (select label, (row_number() over (partition by label order by md5(concat(cast(o_orderkey as varchar), ':42')), o_orderkey) - 1) % 3 as fold
  from sided where not is_test)
select label, cast(fold as int) as fold, count(*) as held_out, 64 as candidates from folded group by label, fold"""
ORACLES["boosted_stump"] = f"""with {_ORDERS},
facts as (
  select f.label, l.lines, l.discount, length(c.c_mktsegment) as segment
  from frame f left join customer c on c.c_custkey = f.o_custkey
  left join (select l_orderkey, count(*) as lines, max(l_discount) as discount from lineitem group by l_orderkey) l on l.l_orderkey = f.o_orderkey),
weights as (select count(*) / (2.0::double * count(*) filter (label = 0)) as w0, 3 * count(*) / (2.0::double * count(*) filter (label = 1)) as w1 from facts),
start as (select (w1 * count(*) filter (label = 1)) / (w1 * count(*) filter (label = 1) + w0 * count(*) filter (label = 0)) as p
  from facts, weights group by w0, w1),
graded as (
  select facts.*, case when label = 1 then w1 else w0 end * (p - label) as g, case when label = 1 then w1 else w0 end * p * (1 - p) as h
  from facts, weights, start),
cells as (
  select 1 as place, 'lines' as feature, lines::double as v, g, h from graded
  union all select 2, 'discount', discount::double, g, h from graded union all select 3, 'segment', segment::double, g, h from graded),
total as (select sum(g) as g, sum(h) as h, count(*) as n from graded),
cuts as (select place, feature, v, sum(g) as g, sum(h) as h, count(*) as n from cells where v is not null group by place, feature, v),
missing as (select feature, sum(g) as mg, sum(h) as mh, count(*) as mn from cells where v is null group by feature),
below as (
  select place, feature, v as cut, coalesce(sum(g) over w, 0) as lg, coalesce(sum(h) over w, 0) as lh, coalesce(sum(n) over w, 0) as ln
  from cuts window w as (partition by feature order by v rows between unbounded preceding and 1 preceding)
  union all select place, feature, null, sum(g), sum(h), sum(n) from cuts group by place, feature),
sides as (  -- missing values go to the side that gains more
  select place, feature, cut, side, lg + side * coalesce(mg, 0) as lg, lh + side * coalesce(mh, 0) as lh, ln + side * coalesce(mn, 0) as ln
  from below left join missing using (feature), (select unnest([0, 1]) as side)),
gains as (
  select *, pow(greatest(abs(lg) - 0.5, 0), 2) / (lh + 2) + pow(greatest(abs(total.g - lg) - 0.5, 0), 2) / (total.h - lh + 2)
    - pow(greatest(abs(total.g) - 0.5, 0), 2) / (total.h + 2) as gain,
    0.1 * -sign(lg) * greatest(abs(lg) - 0.5, 0) / (lh + 2) as left_value,
    0.1 * -sign(total.g - lg) * greatest(abs(total.g - lg) - 0.5, 0) / (total.h - lh + 2) as right_value, total.n - ln as rn
  from sides, total where ln >= 30 and total.n - ln >= 30)
select feature, cut, round(gain, 4) as gain, cast(ln as bigint) as left_n, cast(rn as bigint) as right_n,
  round(left_value, 4) as left_value, round(right_value, 4) as right_value
from gains order by gains.gain desc, place, cut nulls last, side limit 1"""
ORACLES["run_life_cycle"] = """
select case o_orderstatus when 'F' then 'FINISHED' when 'O' then 'RUNNING' else 'FAILED' end as status, count(*) as runs,
  count(*) filter (o_orderstatus <> 'O') as measured from orders group by all"""

# --- round trips and the whole preparation
ORACLES["cohort_views"] = ORACLES["cohort_wide_fanout"]
ORACLES["csv_round_trip"] = ORACLES["cohort_wide"]
ORACLES["metrics_round_trip"] = ORACLES["binary_metrics"]
ORACLES["run_log_round_trip"] = ORACLES["finished_runs"]
ORACLES["params_round_trip"] = f"""select name,
  case when as_int is not null then 'int' when as_double is not null then 'float' else 'str' end as kind
from ({ORACLES["best_params"]}) where value is not null"""
ORACLES["tables_round_trip"] = clinical_sql(" union all ".join(
    f"select '{name}' as name, count(*) as n from {source}" for name, source in [
        *((t, t) for t in ("d_labitems", "labevents", "admissions", "patients", "diagnoses_icd", "omr", "d_nutrition_labs",
                           "nutrition_lab_events", "omr_admit_antho")),
        ("mal_pt_data", "cohort c left join coded k on c.hadm_id = k.hadm_id")]))
ORACLES["scoring_coverage"] = """select count(*) as total,
  count(*) filter (where l_linestatus = 'F' and l_returnflag <> 'R' and l_extendedprice > 5000) as used,
  count(*) filter (where (l_linestatus = 'F') is not true) as no_label, count(*) filter (where (l_returnflag <> 'R') is not true) as no_prediction,
  count(*) filter (where (l_extendedprice > 5000) is not true) as no_score from lineitem"""
ORACLES["prepare_admissions"] = clinical_sql("").rstrip() + """,
sided as (select *, row_number() over (partition by has_malnutrition order by md5(concat(cast(hadm_id as varchar), ':42')), hadm_id)
  <= round(count(*) over (partition by has_malnutrition) * 0.2::double) as is_test from grouped)
select is_test, has_malnutrition, race_grouped, admit_type_grouped, admit_loc_grouped, count(*) as n, count(height_cm) as measured,
  0 as missing, 0 as changed from sided group by all"""
