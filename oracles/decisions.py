"""Expected results: policy, contracts, batch scoring, what-if, gates, cases, explanations."""

from oracles.base import CLEAN, LINES, RULED, SCORED, q, scorecard
from oracles.metrics import FAIR, SC, evaluate

INPUTS = ["Age", "Gender", "AnnualIncome", "NumberOfPurchases", "ProductCategory", "TimeSpentOnWebsite", "LoyaltyProgram", "DiscountsAvailed"]
CODED = ["Gender", "ProductCategory", "LoyaltyProgram"]
FLOATS = ["AnnualIncome", "TimeSpentOnWebsite"]
FEATURES = ["Age", "AnnualIncome", "NumberOfPurchases", "TimeSpentOnWebsite", "Gender", "ProductCategory", "LoyaltyProgram"]

CATALOG = """
cat as (select * from (values
 ('holdout_low_cost_nurture', 0e0, 0.01e0, 0.1e0, 'email_or_push', 'low_intent_holdout'),
 ('targeted_standard_discount', 0.1e0, 0.15e0, 0.5e0, 'email_plus_web_banner', 'lower_targeting_band'),
 ('targeted_light_discount', 0.05e0, 0.08e0, 0.4e0, 'onsite_or_email', 'upper_targeting_band'),
 ('protect_margin_no_discount', 0e0, 0e0, 0e0, 'none', 'high_confidence_no_discount'),
 ('manual_review_discount_cap', 0.05e0, 0.05e0, 0.6e0, 'manual_queue', 'lower_targeting_band|upper_targeting_band|high_confidence_no_discount')
 ) t(action, discount_rate, expected_uplift, contact_cost, channel, target_bands))"""


def near():
    return "(round(abs(p-0.2e0),6)<=0.03e0 or round(abs(p-0.3e0),6)<=0.03e0 or round(abs(p-0.45e0),6)<=0.06e0)"


def decide(src, dst):
    """CTE chain: policy columns on src(p, DiscountsAvailed)."""
    return f""",
{dst}_b as (select *, case when p<0.2e0 then 'low_intent_holdout' when p<0.3e0 then 'lower_targeting_band' when p<0.45e0 then 'upper_targeting_band'
   when p is not null then 'high_confidence_no_discount' end score_band, coalesce(cast(DiscountsAvailed as double),0e0) hist from {src}),
{dst}_a as (select *, case score_band when 'low_intent_holdout' then 'holdout_low_cost_nurture' when 'lower_targeting_band' then 'targeted_standard_discount'
   when 'upper_targeting_band' then 'targeted_light_discount' when 'high_confidence_no_discount' then 'protect_margin_no_discount' end base_action from {dst}_b),
{dst}_f as (select *, base_action in ('targeted_standard_discount','targeted_light_discount') and hist>=4 sat,
   base_action='targeted_standard_discount' and hist>=3 and hist<4 dow, {near()} nr from {dst}_a),
{dst}_r as (select * exclude (hist), case when sat then 'manual_review_discount_cap' when dow then 'targeted_light_discount' else base_action end recommended_action,
   sat or nr requires_manual_review, array_to_string(list_filter([case when sat then 'historical_discount_saturation' end, case when dow then 'discount_intensity_downgraded' end,
   case when nr then 'threshold_boundary_review' end], lambda x: x is not null), '|') guardrail_flags from {dst}_f),
{dst}_v as (select r.*, discount_rate recommended_discount_rate, channel primary_channel, contact_cost cc_, least(0.99e0, p+expected_uplift) pa, greatest(0e0, 35e0-discount_rate*100e0) kept
   from {dst}_r r left join cat on cat.action=r.recommended_action),
{dst} as (select * exclude (sat, dow, nr, pa, kept, cc_), round(p*35e0,6) baseline_expected_margin, round(pa*kept-cc_,6) action_expected_margin, round(pa,6) expected_probability_after_action,
   round(pa*kept-cc_-p*35e0,6) proxy_incremental_value, recommended_discount_rate>0 discount_offered from {dst}_v)"""


DECIDED = SCORED + "," + CATALOG.lstrip() + decide("sc", "de")


def rules(src, dst="ru_"):
    """CTE: one row per contract column."""
    parts = []
    for c in INPUTS:
        if c in CODED:
            parts.append(f"""select '{c}' column_name, 'categorical_integer' kind, cast(null as double) min_value, cast(null as double) max_value,
              list_sort(list_distinct(list(cast({c} as int)) filter (where {c} is not null))) allowed, cast(min({c}) as double) example_value from {src}""")
        elif c in FLOATS:
            parts.append(f"""select '{c}', 'float_range', round(min({c}),6), round(max({c}),6), cast(null as int[]), cast(printf('%.6f', (min({c})+max({c}))/2) as double) from {src}""")
        else:
            parts.append(f"""select '{c}', 'integer_range', cast(min({c}) as double), cast(max({c}) as double), cast(null as int[]), cast(round_even((min({c})+max({c}))/2e0,0) as double) from {src}""")
    return f", {dst}(column_name, kind, min_value, max_value, allowed, example_value) as (" + " union all ".join(parts) + ")"


ALLOWED = "array_to_string(allowed, '|') allowed_values"

RAW = """,
raw as (select profile_id,
  case when profile_id%13=0 then 'abc' when profile_id%17=0 then '99' else cast(Age as varchar) end Age,
  case when profile_id%19=0 then ' ' else cast(Gender as varchar) end Gender,
  case when profile_id%23=0 then 'Infinity' else cast(AnnualIncome as varchar) end AnnualIncome,
  case when profile_id%29=0 then '2.5' else concat(' ',NumberOfPurchases) end NumberOfPurchases,
  case when profile_id%31=0 then '7' else cast(ProductCategory as varchar) end ProductCategory,
  case when profile_id%37=0 then '1e9' else cast(TimeSpentOnWebsite as varchar) end TimeSpentOnWebsite,
  cast(LoyaltyProgram as varchar) LoyaltyProgram,
  case when profile_id%41=0 then '-1' else cast(DiscountsAvailed as varchar) end DiscountsAvailed from cp)"""


def violation(c, src="ru_"):
    n = f"try_cast(trim({c}) as double)"
    rule = lambda f: f"(select {f} from {src} where column_name='{c}')"
    out = [f"when {c} is null or trim({c})='' then '{c}:blank'", f"when {n} is null or isnan({n}) then '{c}:not_numeric'",
           f"when isinf({n}) then '{c}:not_finite'"]
    if c not in FLOATS:
        out.append(f"when {n}<>floor({n}) then '{c}:not_integer'")
    if c in CODED:
        out.append(f"when not list_contains({rule('allowed')}, cast({n} as int)) then '{c}:not_allowed'")
    else:
        out.append(f"when {n}<{rule('min_value')} or {n}>{rule('max_value')} then '{c}:out_of_range'")
    return "case " + " ".join(out) + " end"


CHECKED = CLEAN + rules("cd") + RAW + ", ck as (select *, list_filter([" + ", ".join(violation(c) for c in INPUTS) + "], lambda x: x is not null) vio from raw)"
VALID = CHECKED + ", va as (select profile_id, " + ", ".join(
    f"round(try_cast(trim({c}) as double),6) {c}" if c in FLOATS else f"cast(try_cast(trim({c}) as double) as int) {c}" for c in INPUTS
) + " from ck where len(vio)=0)" + scorecard("va", "vs") + "," + CATALOG.lstrip() + decide("vs", "vd")
RATIONALE = """'score in '||score_band||' suggests '||base_action||(case when recommended_action<>base_action then '; moved to '||recommended_action else '' end)
   ||(case when requires_manual_review then '; manual review' else '' end)"""

def rule(c, f):
    return f"(select {f} from ru_ where column_name='{c}')"


def mutations():
    """Expected outcome of every change of one field: all valid rows pass it, or none."""
    rows = []
    for c in INPUTS:
        kinds = [("known_code", "true"), ("unknown_code", "false")] if c in CODED else [
            ("at_lower_bound", "true"), ("at_upper_bound", "true"), ("below_range", "false"), ("above_range", "false")]
        rows += [f"('{m}', '{c}', {ok})" for m, ok in [*kinds, ("left_blank", "false"), ("not_a_number", "false")]]
    return ", ".join(rows)


WHOLE = CLEAN + ", whole as (select count(*) n from cd where " + " and ".join(f"{c} is not null" for c in INPUTS) + ")"


def bounded(c, delta):
    lo, hi = f"(select min(cast({c} as double)) from lp)", f"(select max(cast({c} as double)) from lp)"
    v = f"least(greatest(cast({c} as double)+({delta}),{lo}),{hi})"
    return f"round_even({v},0)" if c == "NumberOfPurchases" else f"round({v},6)"


def variants():
    ts = "(select greatest(1e0,(max(TimeSpentOnWebsite)-min(TimeSpentOnWebsite))*0.05e0) from lp)"
    ins = "(select (round(max(AnnualIncome),6)-round(min(AnnualIncome),6))*0.05e0 from lp)"
    changes = [
        ("time_spent_up", "TimeSpentOnWebsite", bounded("TimeSpentOnWebsite", ts)), ("time_spent_down", "TimeSpentOnWebsite", bounded("TimeSpentOnWebsite", "-" + ts)),
        ("purchase_count_up", "NumberOfPurchases", bounded("NumberOfPurchases", "1")), ("purchase_count_down", "NumberOfPurchases", bounded("NumberOfPurchases", "-1")),
        ("income_up", "AnnualIncome", bounded("AnnualIncome", ins)), ("income_down", "AnnualIncome", bounded("AnnualIncome", "-" + ins)),
        ("loyalty_toggle", "LoyaltyProgram", "cast(1-LoyaltyProgram as double)"),
    ]
    cols = [c for c in INPUTS]
    parts = [
        f"select row_id, '{v}' variant_id, '{f}' field_name, bp, bb, ba, br, " + ", ".join(
            (f"{'cast(' + e + ' as int)' if c in ('NumberOfPurchases', 'LoyaltyProgram') else e} {c}" if c == f else c) for c in cols)
        + f" from bs where {e}<>cast({f} as double)" for v, f, e in changes]
    return ", bs as (select row_id, " + ", ".join(cols) + ", p bp, score_band bb, recommended_action ba, requires_manual_review br from de), vr as (" + " union all ".join(parts) + ")" \
        + scorecard("vr", "vrs") + decide("vrs", "vrd") + """,
vx as (select row_id, variant_id, field_name, bp, bb, ba, round(abs(p-bp),6) d, recommended_action<>ba ac, score_band<>bb bc, requires_manual_review<>br rc from vrd),
vsum as (select row_id, bb, count(*) k, max(d) md, count(case when ac then 1 end) nac, count(case when bc then 1 end) nbc, count(case when rc then 1 end) nrc from vx group by 1,2)"""


VARIANTS = DECIDED + variants()


def pick_cases(src, side="test", prefix=""):
    """CTE chain: greedy reference cases of one side of the split, in category order, as <prefix>rc."""
    order = [
        ("high_confidence_true_positive", "PurchaseStatus=1 and yhat=1 and p>=0.8e0", "-p"),
        ("high_confidence_true_negative", "PurchaseStatus=0 and yhat=0 and p<=0.2e0", "p"),
        ("boundary_case", "true", "round(abs(p-0.5e0),6)"),
        ("false_positive", "PurchaseStatus=0 and yhat=1", "-p"),
        ("false_negative", "PurchaseStatus=1 and yhat=0", "-p"),
        ("loyalty_positive_intent", "LoyaltyProgram=1 and p>=0.65e0", "-p"),
        ("non_loyal_high_time", f"LoyaltyProgram=0 and TimeSpentOnWebsite>=(select quantile_cont(TimeSpentOnWebsite,0.75) from {src})", "-TimeSpentOnWebsite, -p"),
        ("low_history_surprise_purchase", f"NumberOfPurchases<=(select quantile_cont(cast(NumberOfPurchases as double),0.25) from {src}) and PurchaseStatus=1", "-p"),
    ]
    out = []
    for i, (name, where, sort) in enumerate(order):
        used = " and row_id not in (" + " union all ".join(f"select row_id from {prefix}c{j}" for j in range(i)) + ")" if i else ""
        out.append(f"{prefix}c{i} as (select '{name}' case_id, * from {src} where {where}{used} order by {sort}, row_id limit 1)")
    found = " union all ".join(f"select * from {prefix}c{j}" for j in range(8))
    out.append(f"{prefix}cs8 as ({found})")
    out.append(f"""{prefix}fb as (select 'fallback_'||((select count(*) from {prefix}cs8)+row_number() over (order by round(abs(p-0.5e0),6), row_id)) case_id, * from {src}
      where row_id not in (select row_id from {prefix}cs8) order by round(abs(p-0.5e0),6), row_id limit 8)""")
    out.append(f"{prefix}rc as (select * from {prefix}cs8 union all select * from {prefix}fb where cast(substr(case_id,10) as int)<=8)")
    return f", {src} as (select * from sc where split='{side}'), " + ", ".join(out)


CASES = SCORED + pick_cases("te")


def attributed(scored, name):
    """CTE chain: exact Shapley values from the scored coalitions, in whole millionths until the last division."""
    weight = lambda i: f"(case when (mask & {1 << i})<>0 then {WEIGHTS!r}[bit_count(mask)] else -{WEIGHTS!r}[bit_count(mask)+1] end)"
    sums = ", ".join(f"sum(cast(round(p*1000000) as bigint)*{weight(i)}) s{i}" for i in range(len(FEATURES)))
    return f""",
{name}w as (select row_id, {sums}, sum(case when mask=0 then cast(round(p*1000000) as bigint) end) sb, count(case when mask=0 then 1 end) nb from {scored} group by 1),
{name} as (""" + " union all ".join(
        f"select row_id, '{c}' feature_name, round(cast(s{i} as double)/(nb*5040))/1000000 phi, round(cast(sb as double)/nb)/1000000 base_value from {name}w" for i, c in enumerate(FEATURES)) + ")"


def shapley(rows):
    """CTE chain mx, phi: every coalition of every row, and its Shapley values under the scorecard."""
    mix = ", ".join(f"case when (mask & {1 << i})<>0 then e.{c} else b.{c} end {c}" for i, c in enumerate(FEATURES))
    return f""",
bgd as (select * from lp where split<>'test' order by md5(concat(row_id,':42:sample')), row_id limit 20),
exr as (select row_id, {', '.join(FEATURES)} from {rows}),
mk as (select cast(m as int) mask from range(128) t(m)),
mx as (select e.row_id, mask, {mix} from exr e, mk, bgd b)""" + scorecard("mx", "mxs") + attributed("mxs", "phi")


from math import factorial  # noqa: E402

WEIGHTS = [factorial(s) * factorial(6 - s) for s in range(7)]
SHAP = SCORED + ", te as (select * from sc where split='test')" + shapley("te")
RULE_P = """round(least(greatest(0.45e0*cast(LoyaltyProgram as double) + 0.35e0*(case when NumberOfPurchases>=mp then 1e0 else 0e0 end) + 0.2e0*(case when TimeSpentOnWebsite>=mt then 1e0 else 0e0 end),0e0),1e0),6) p"""
GLOBAL = "select feature_name, round(avg(abs(phi)),6) mean_abs_shap, round(avg(phi),6) mean_signed_shap from phi group by 1"
TOP = ", tk as (select *, row_number() over (partition by row_id order by abs(phi) desc, feature_name) rk from phi)"

PERM = LINES + ", te as (select * from lp where split='test'), " + f"""
bo as (select *, row_number() over (order by md5(concat(row_id,':42:order'))) pos from te),
dn as (select r rep, row_number() over (partition by r order by md5(concat(row_id,':42:shuffle:',r))) pos, {', '.join(f'{c} d_{c}' for c in FEATURES)} from te, range(1,9) t(r)),
pa as (select bo.*, dn.* exclude (pos) from bo join dn on bo.pos=dn.pos),
sh as (""" + " union all ".join(
    f"select '{f}' feature_name, rep, PurchaseStatus, " + ", ".join(f"d_{c} {c}" if c == f else c for c in FEATURES) + " from pa" for f in FEATURES
) + " union all select '(intact)', 0, PurchaseStatus, " + ", ".join(FEATURES) + " from te)" + scorecard("sh", "shs") + ", shy as (select feature_name, rep, p, yhat, PurchaseStatus y from shs)" \
    + evaluate("shy", ["feature_name", "rep"])

STAT = "count(*) row_count"


def mean(c, alias):
    return f"round(avg(cast({c} as double)),6) {alias}"


SQL = {
    "score_bands": q(DECIDED, "select score_band, count(*) row_count from de group by 1"),
    "boundary_review": q(SCORED, f"select {near()} near_threshold, count(*) row_count from sc group by 1"),
    "proxy_value": q(DECIDED, "select recommended_action, " + ", ".join(f"round(avg({c}),6) {c}" for c in (
        "baseline_expected_margin", "action_expected_margin", "expected_probability_after_action", "proxy_incremental_value")) + " from de group by 1"),
    "policy_actions": q(DECIDED, "select score_band, base_action, recommended_action, requires_manual_review, guardrail_flags, primary_channel, count(*) row_count from de group by all"),
    "score_rejects": q(SCORED + """, dm as (select * replace (case NumberOfPurchases when 3 then null when 5 then 'NaN'::double when 7 then 1.7e0 when 11 then -0.3e0 else p end as p,
        case when NumberOfPurchases=13 then -2 else DiscountsAvailed end as DiscountsAvailed), NumberOfPurchases in (3, 5, 7, 11) bad_p, NumberOfPurchases=13 bad_h from sc),""" + CATALOG.lstrip() + decide("dm", "dd"), """
      select case when bad_p then 'unscored' else score_band end score_band, case when bad_p or bad_h then 'none' else recommended_action end as "action",
        bad_p or bad_h or requires_manual_review requires_manual_review, case when bad_p then 'score_rejected' when bad_h then 'history_rejected' else guardrail_flags end guardrail_flags,
        count(*) row_count from dd group by 1,2,3,4"""),
    "policy_frame": q(DECIDED, """select row_id, p, yhat, score_band, base_action, recommended_action, recommended_discount_rate, requires_manual_review, guardrail_flags, primary_channel,
      baseline_expected_margin, action_expected_margin, expected_probability_after_action, proxy_incremental_value, discount_offered from de where split='test'"""),
    "policy_band_summary": q(DECIDED, f"""select score_band, {STAT}, {mean('PurchaseStatus', 'observed_purchase_rate')}, {mean('p', 'average_predicted_probability')},
      {mean('recommended_discount_rate', 'average_discount_rate')}, {mean('requires_manual_review', 'manual_review_share')}, {mean('proxy_incremental_value', 'average_proxy_incremental_value')},
      round(count(*)/sum(count(*)) over (),6) "share" from de group by 1"""),
    "action_mix": q(DECIDED, f"""select recommended_action, {STAT}, {mean('p', 'average_predicted_probability')}, {mean('recommended_discount_rate', 'average_discount_rate')},
      {mean('proxy_incremental_value', 'average_proxy_incremental_value')}, round(count(*)/sum(count(*)) over (),6) "share" from de group by 1"""),
    "loyalty_monitor": q(DECIDED, f"""select *, round(abs(max(case when loyalty=1 then discount_action_share end) over () - max(case when loyalty=0 then discount_action_share end) over ()),6) observed_discount_action_gap
      from (select LoyaltyProgram loyalty, {STAT}, {mean('discount_offered', 'discount_action_share')}, {mean('requires_manual_review', 'manual_review_share')},
      {mean('proxy_incremental_value', 'average_proxy_incremental_value')} from de group by 1)"""),
    "portfolio_value": q(DECIDED, """select round(avg(proxy_incremental_value),6) average_value, cast(sum(cast(proxy_incremental_value as decimal(28,6))) as double) total_value,
      round(avg(cast(proxy_incremental_value>0 as double)),6) positive_share from de"""),
    "action_catalog": q(DECIDED, """select cat.*, coalesce(k,0) row_count from cat left join (select recommended_action a, count(*) k from de group by 1) u on u.a=cat.action"""),
    "guardrail_status": q(FAIR + "," + CATALOG.lstrip() + decide("sc", "de") + """, gg as (select round(abs(avg(case when LoyaltyProgram=1 then cast(discount_offered as double) end)
      -avg(case when LoyaltyProgram=0 then cast(discount_offered as double) end)),6) g, (select count(*) from gp where gap_value>=0.12) a from de)""",
      """select 'discount_history_cap' guardrail_id, 'high' severity, 'active' status, cast(null as double) observed_gap union all
      select 'threshold_boundary_review', 'medium', 'active', null union all select 'margin_protection_high_confidence', 'medium', 'active', null union all
      select 'loyalty_fairness_monitor', case when a>0 or g>0.12 then 'high' else 'medium' end, case when a>0 or g>0.12 then 'alert' else 'watch' end, g from gg"""),
    "scorecard_offer": q(SCORED + """, of as (select *, case when p<0.2e0 then 'low_intent_holdout' when p<0.3e0 then 'lower_targeting_band' when p<0.45e0 then 'upper_targeting_band'
      else 'high_confidence_no_discount' end risk_band, round(least(abs(p-0.3e0),abs(p-0.45e0)),6)<=0.025e0 requires_manual_review, cast(floor(p*100+0.5e0) as int) s from sc),
      og as (select *, case when s>=75 then 0e0 else round(ceil((75-s)/2e0)/100e0,2) end automatic_discount_rate from of)""",
      """select risk_band, case when requires_manual_review then 'manual_review_discount_cap' when risk_band='low_intent_holdout' then 'holdout_low_cost_nurture'
      when risk_band='lower_targeting_band' then 'targeted_standard_discount' when risk_band='upper_targeting_band' then 'targeted_light_discount' else 'protect_margin_no_discount' end "action",
      requires_manual_review, automatic_discount_rate, cast(floor(89999*(1e0-automatic_discount_rate)+0.5e0) as bigint) discounted_price, yhat predicted_label, count(*) row_count from og group by all"""),
    "metric_alignment": q(SC + evaluate("sy", []), " union all ".join(
        f"select 'scorecard' model_name, '{n}' metric_name, {n} stored_value, {n} fresh_value, 0e0 delta, true aligned from m" for n in ("pr_auc", "balanced_accuracy", "brier_score"))),
    "input_rules": q(CLEAN + rules("cd"), f"select column_name, kind, min_value, max_value, {ALLOWED}, example_value from ru_"),
    "rule_rounding": q(CLEAN + rules("cd") + ", st as (select *, case when column_name='AnnualIncome' then 1000e0 else 1e0 end s from ru_ where column_name<>'DiscountsAvailed')",
        f"""select column_name, kind, case when kind='float_range' then floor(min_value/s)*s else min_value end min_value, case when kind='float_range' then ceil(max_value/s)*s else max_value end max_value,
        {ALLOWED}, case when kind='float_range' then floor(example_value/s+0.5e0)*s else example_value end example_value from st"""),
    "contract_violations": q(CHECKED, "select profile_id, array_to_string(vio,'|') violations from ck"),
    "contract_summary": q(CHECKED, "select reason, count(*) row_count from (select unnest(case when len(vio)=0 then ['valid'] else vio end) reason from ck) group by 1"),
    "batch_score": q(VALID, f"""select profile_id, p purchase_score, yhat predicted_label, score_band risk_band, recommended_action, recommended_discount_rate, requires_manual_review, guardrail_flags,
      {RATIONALE} short_rationale from vd"""),
    "scoring_overview": q(DECIDED, """select recommended_action outcome, count(*) row_count, count(case when requires_manual_review then 1 end) manual_review_count,
      round(count(*)/sum(count(*)) over (),6) "share" from de group by 1"""),
    "scoring_log": q(DECIDED, """select row_id, p predicted_probability, yhat predicted_label, score_band, recommended_action, recommended_discount_rate, requires_manual_review, guardrail_flags,
      true action_match, true band_match, 0e0 probability_delta from de where split='test'"""),
    "replay_alignment": q(RULED + scorecard("lp", "sc") + "," + CATALOG.lstrip() + decide("sc", "de") + decide("ru", "rd"), """select action_match, band_match, manual_review_match,
      action_match and band_match and manual_review_match and d<=1e-6 aligned, count(*) row_count, max(round(d,6)) max_probability_delta from (select a.recommended_action=b.recommended_action action_match,
      a.score_band=b.score_band band_match, a.requires_manual_review=b.requires_manual_review manual_review_match, round(abs(a.p-b.p),9) d from de a join rd b on a.row_id=b.row_id) group by 1,2,3,4"""),
    "edge_case_matrix": q(WHOLE, f"""select mutation, column_name, expected_valid, case when expected_valid then n else 0 end accepted_rows, case when expected_valid then 0 else n end refused_rows, 'passed' status
      from whole, (values {mutations()}) t(mutation, column_name, expected_valid) where n > 0"""),
    "sensitivity_variants": q(VARIANTS, """select variant_id, field_name, count(*) variant_count, round(avg(d),6) mean_probability_delta, max(d) max_probability_delta,
      count(case when ac then 1 end) action_change_count, count(case when bc then 1 end) band_change_count, count(case when rc then 1 end) manual_review_change_count from vx group by 1,2"""),
    "sensitivity_summary": q(VARIANTS, """select bb base_band, case when nac=0 and nbc=0 then 'stable' else 'monitor' end stability_assessment, count(*) row_count, cast(sum(k) as bigint) variant_count,
      round(avg(md),6) mean_max_delta, max(md) max_probability_delta, cast(sum(nac) as bigint) action_change_count, cast(sum(nbc) as bigint) band_change_count,
      cast(sum(nrc) as bigint) manual_review_change_count from vsum group by 1,2"""),
    "rerun_consistency": q(LINES, """select cast(2 as int) runs_evaluated, 2*count(*) compared_rows, 0e0 max_probability_delta, cast(0 as bigint) action_mismatch_count, cast(0 as bigint) band_mismatch_count,
      cast(0 as bigint) manual_review_mismatch_count, cast(0 as bigint) missing_rows, true deterministic from lp"""),
    "contract_drift": q(CLEAN + rules("(select * from cd where split='train')", "ra") + rules("cd", "rb"), """select column_name, case when chg='' then 'same' else 'changed' end status, chg changed_parts from
      (select ra.column_name, array_to_string(list_filter([case when ra.min_value is distinct from rb.min_value then 'min_value' end, case when ra.max_value is distinct from rb.max_value then 'max_value' end,
      case when ra.allowed is distinct from rb.allowed then 'allowed_values' end, case when ra.example_value is distinct from rb.example_value then 'example_value' end], lambda x: x is not null),'|') chg
      from ra join rb on ra.column_name=rb.column_name)"""),
    "stage_consistency": q(CLEAN, """select 'raw_row_count_alignment' check_id, 'passed' status, count(*) figure from cp union all
      select 'dedup_row_count_alignment', 'passed', count(*) from cd union all select 'champion_alignment', 'passed', 4"""),
    "readiness": q(WHOLE + ", " + LINES.strip() + scorecard("lp", "sc"), """select check_id, case when ok then 'ready' else 'missing' end status, case when min(ok) over () then 'ready' else 'missing' end overall_status from
      (select 'scored_table' check_id, (select count(*) from sc)>0 ok union all select 'edge_case_controls', (select n from whole)>0 union all select 'sensitivity_analysis', (select count(*) from sc)>0
      union all select 'reproducibility', true union all select 'fairness_followup', true)"""),
    "reference_cases": q(CASES, "select case_id, row_id, p, yhat, PurchaseStatus from rc"),
    "case_policy": q(CASES + shapley("rc") + TOP + "," + CATALOG.lstrip() + decide("rc", "rd"), """select case_id, row_id, p, score_band, recommended_action, requires_manual_review, guardrail_flags,
      (select string_agg(feature_name, '|' order by rk) from tk where tk.row_id=rd.row_id and rk<=2) top_drivers from rd"""),
    "case_checks": q(CASES + "," + CATALOG.lstrip() + decide("rc", "rd"), """select max(case when case_id='false_positive' then recommended_discount_rate=0 end) false_positive_margin_protection,
      max(case when case_id='boundary_case' then requires_manual_review end) boundary_case_manual_review,
      max(case when case_id='non_loyal_high_time' then recommended_discount_rate>0 or requires_manual_review end) non_loyal_high_time_not_ignored from rd"""),
    "case_union": q(CASES + pick_cases("tv", "validation", "v"), f"select case_id, {', '.join(INPUTS)}, 'test' origin from rc union all select case_id, {', '.join(INPUTS)}, 'validation' from vrc"),
    "explain_join": q(SHAP + "," + CATALOG.lstrip() + decide("te", "td") + TOP, """select recommended_action, feature_name strongest_driver, count(*) row_count, count(*) explained_rows
      from td join tk on tk.row_id=td.row_id and rk=1 group by 1,2"""),
    "permutation_importance_scorecard": q(PERM, """select feature_name, round(avg(d),6) importance_mean, round(stddev_pop(d),6) importance_std from
      (select feature_name, (select pr_auc from m where feature_name='(intact)')-pr_auc d from m where feature_name<>'(intact)') group by 1"""),
    "shapley_scorecard": q(SHAP, "select * from phi"),
    "shapley_global": q(SHAP, GLOBAL),
    "top_contributions": q(SHAP + TOP, """select row_id, cast(rk as int) "rank", feature_name, phi, base_value, case when phi>=0 then 'increases_purchase_probability' else 'decreases_purchase_probability' end direction
      from tk where rk<=4"""),
    "shapley_dependence": q(SHAP, f"""select phi.row_id, feature_name, case feature_name {' '.join(f"when '{c}' then cast({c} as double)" for c in FEATURES)} end feature_value, phi from phi join exr on exr.row_id=phi.row_id
      where feature_name=(select feature_name from ({GLOBAL}) order by mean_abs_shap desc, feature_name limit 1)"""),
    "shared_drivers": q(SHAP + f""", ga as (select feature_name from ({GLOBAL}) order by mean_abs_shap desc, feature_name limit 3),
      med as (select quantile_cont(cast(NumberOfPurchases as double),0.5) mp, quantile_cont(TimeSpentOnWebsite,0.5) mt from lp where split='train'),
      mxr as (select row_id, mask, {RULE_P} from mx, med)""" + attributed("mxr", "phr") + """,
      gb as (select feature_name from (select feature_name, round(avg(abs(phi)),6) a from phr group by 1) order by a desc, feature_name limit 3)""",
      "select feature_name from ga intersect select feature_name from gb"),
}
