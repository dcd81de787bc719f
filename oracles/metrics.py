"""Expected results: splits, deterministic scorers, metrics, selection, fairness."""

from oracles.audit import FEATURES
from oracles.base import CLEAN, LINES, RULED, SCORED, q, scorecard

CANDIDATES = RULED + """,
pr_ as (select avg(PurchaseStatus) prior from lp where split='train'),""" + scorecard("lp", "sc").lstrip(" ,\n") + """,
all_scored as (
  select 'majority_baseline' model_name, 'dummy' family, round(prior,6) p, cast(case when prior>0.5 then 1 else 0 end as int) yhat, PurchaseStatus y from lp, pr_ where split='test'
  union all
  select 'random_baseline', 'dummy', cast(h as double), h, y from (select cast(case when cast(cast(('0x'||substr(md5(concat(row_id,':42:draw')),1,6)) as int) as double)/16777216e0 < prior
     then 1 else 0 end as int) h, PurchaseStatus y from lp, pr_ where split='test')
  union all
  select 'rule_based_baseline', 'heuristic', p, yhat, PurchaseStatus from ru where split='test'
  union all
  select 'scorecard', 'heuristic', p, yhat, PurchaseStatus from sc where split='test')"""


def evaluate(src, by, slices=False):
    """CTE chain m: one row per group of src(p, yhat, y) with all metrics."""
    keys = ", ".join(by) + ", " if by else ""
    part = f"partition by {', '.join(by)}" if by else ""
    group = f"group by {', '.join(by)}" if by else ""
    ba = "(rec+spec)/2" if slices else "case when P>0 and N>0 then (rec+spec)/2 when P>0 then rec else spec end"
    return f""",
lad as (select {keys}p, sum(y) pos, sum(1-y) neg, sum(case when y=1 and yhat=1 then 1 else 0 end) tp, sum(case when y=0 and yhat=1 then 1 else 0 end) fp from {src} group by {keys}p),
cum as (select *, sum(pos) over ({part} order by p desc rows unbounded preceding) cp_, sum(neg) over ({part} order by p desc rows unbounded preceding) cn_ from lad),
agg as (select {keys}cast(sum(pos) as double) P, cast(sum(neg) as double) N, cast(sum(tp) as bigint) tp, cast(sum(fp) as bigint) fp,
   sum(cast(neg as double)*(cp_-pos/2e0)) au, sum(cast(pos as double)*cp_/(cp_+cn_)) ap,
   sum(pos*(1e0-p)*(1e0-p)+neg*p*p) sq from cum {group}),
der as (select *, cast(N as bigint)-fp tn, cast(P as bigint)-tp fn, coalesce(tp/nullif(tp+fp,0),0e0) prec, coalesce(tp/nullif(P,0),0e0) rec, (N-fp)/nullif(N,0) spec from agg),
m as (select {keys}cast(P+N as bigint) row_count, round(P/(P+N),6) positive_rate, round((tp+tn)/(P+N),6) accuracy, round(prec,6) "precision", round(rec,6) recall,
   round(coalesce(2*prec*rec/nullif(prec+rec,0),0e0),6) f1, round(case when P>0 and N>0 then au/(P*N) end,6) roc_auc, round(case when P>0 and N>0 then ap/P end,6) pr_auc,
   round({ba},6) balanced_accuracy, round(sq/(P+N),6) brier_score, tn, fp, fn, tp from der)"""


def calibration(src, by):
    """CTE chain cal: bins of src(p, y) per group, gap: mean absolute gap per group."""
    keys = ", ".join(by) + ", " if by else ""
    sel = ", ".join(f"s.{b}" for b in by) + ", " if by else ""
    on = " and ".join(f"s.{b}=e.{b}" for b in by) or "true"
    group = f"group by {', '.join(by)}" if by else ""
    return f""",
ed as (select {keys}quantile_cont(p, [0.125,0.25,0.375,0.5,0.625,0.75,0.875]) e from {src} {group}),
cal as (select {sel}cast(len(list_filter(e, lambda v: v < s.p)) as int) bin_index, count(*) row_count, round(avg(y),6) true_rate, round(avg(p),6) mean_probability
   from {src} s join ed e on {on} group by all),
gap as (select {keys}round(avg(abs(true_rate-mean_probability)),6) calibration_gap from cal {group})"""


MODELS = CANDIDATES + evaluate("all_scored", ["model_name", "family"]) + calibration("all_scored", ["model_name", "family"]) + """,
mm as (select m.*, gap.calibration_gap from m join gap on m.model_name=gap.model_name)"""


def mapped(pairs):
    whens = " ".join(f"when '{a}' then '{b}'" for a, b in pairs.items())
    inside = ", ".join(f"'{a}'" for a in pairs)
    return MODELS + f""",
cm as (select case model_name {whens} end nm, * exclude (model_name) from mm where model_name in ({inside}))"""


SC = SCORED + ", sy as (select *, PurchaseStatus y from sc)"


def cells(cut):
    return f"""count(case when y=0 and p<{cut} then 1 end) tn, count(case when y=0 and p>={cut} then 1 end) fp,
      count(case when y=1 and p<{cut} then 1 end) fn, count(case when y=1 and p>={cut} then 1 end) tp"""


def cell_metrics(src):
    return f"""select threshold, tn, fp, fn, tp, round(prec,6) "precision", round(rec,6) recall, round(coalesce(2*prec*rec/nullif(prec+rec,0),0e0),6) f1,
      round((rec+spec)/2,6) balanced_accuracy, round(coalesce((tp+fp)/nullif(tp+fp+tn+fn,0),0e0),6) predicted_positive_rate
      from (select *, coalesce(tp/nullif(tp+fp,0),0e0) prec, coalesce(tp/nullif(tp+fn,0),0e0) rec, coalesce(tn/nullif(tn+fp,0),0e0) spec from {src})"""


def sweep(src):
    """CTE chain sw: all 31 thresholds, best: the chosen row."""
    return f""",
th as (select round(0.2e0+i*0.02e0,3) threshold from range(31) t(i)),
swc as (select threshold, {cells('threshold')} from {src}, th group by threshold),
sw as ({cell_metrics('swc')}),
best as (select * from sw order by (case when "precision">=0.55e0 then 1 else 0 end) desc, f1 desc, recall desc, "precision" desc, round(abs(threshold-0.5e0),6), threshold limit 1),
bands as (select case when round(greatest(0.2e0,threshold-0.15e0),6)>=threshold then round(greatest(0.1e0,threshold-0.1e0),6) else round(greatest(0.2e0,threshold-0.15e0),6) end low_action_threshold,
   round(threshold,6) binary_decision_threshold,
   case when round(least(0.85e0,threshold+0.15e0),6)<=threshold then round(least(0.9e0,threshold+0.1e0),6) else round(least(0.85e0,threshold+0.15e0),6) end high_confidence_no_discount_threshold from best)"""


AGE_BAND = "case when Age>=17 and Age<=29 then '18_29' when Age>29 and Age<=44 then '30_44' when Age>44 and Age<=70 then '45_plus' else 'unknown' end"
INCOME_BAND = """case when AnnualIncome>=0 and AnnualIncome<=50000 then 'income_low' when AnnualIncome>50000 and AnnualIncome<=90000 then 'income_mid'
      when AnnualIncome>90000 then 'income_high' else 'unknown' end"""


def segments(income):
    extra = f" union all select p, yhat, y, 'IncomeBand', {INCOME_BAND} from sy" if income else ""
    return f""",
sg as (select p, yhat, y, 'Gender' segment_name, 'gender_'||Gender segment_value from sy
  union all select p, yhat, y, 'LoyaltyProgram', 'loyalty_'||LoyaltyProgram from sy
  union all select p, yhat, y, 'ProductCategory', 'category_'||ProductCategory from sy
  union all select p, yhat, y, 'AgeBand', {AGE_BAND} from sy{extra})"""


RATES = """round((tp+fp)/row_count,6) positive_prediction_rate, round(fp/nullif(fp+tn,0),6) false_positive_rate, round(fn/nullif(fn+tp,0),6) false_negative_rate"""
SLICE = 'segment_name, segment_value, row_count, positive_rate, "precision", recall, f1, roc_auc, pr_auc, balanced_accuracy, tn, fp, fn, tp'
FAIR = SC + segments(False) + evaluate("sg", ["segment_name", "segment_value"], True) + f""",
fm as (select {SLICE}, {RATES} from m where row_count>=20),
ov0 as (select count(case when y=0 and yhat=0 then 1 end) tn, count(case when y=0 and yhat=1 then 1 end) fp,
   count(case when y=1 and yhat=0 then 1 end) fn, count(case when y=1 and yhat=1 then 1 end) tp, count(*) row_count from sy),
ov as (select round(coalesce(tp/nullif(tp+fn,0),0e0),6) recall, round(coalesce(tp/nullif(tp+fp,0),0e0),6) "precision", {RATES} from ov0),
gp as (""" + " union all ".join(
    f"""select segment_name, segment_value, row_count, '{n}' metric_name, fm."{n}" group_value_of_metric, ov."{n}" overall_value,
  round(abs(fm."{n}"-ov."{n}"),6) gap_value from fm, ov"""
    for n in ("recall", "precision", "positive_prediction_rate", "false_positive_rate", "false_negative_rate")) + ")"

NUM = ["Age", "AnnualIncome", "NumberOfPurchases", "TimeSpentOnWebsite"]
ENG = ["income_per_purchase_proxy", "loyalty_time_interaction", "high_time_low_history_flag", "non_loyal_high_time_flag"]
CAT = ["Gender", "ProductCategory", "LoyaltyProgram"]
ENGCAT = ["income_bucket", "purchase_frequency_bucket", "time_spent_bucket", "category_income_interaction"]
MATRIX = FEATURES + ", ftr as (select * from ft where split='train'), md as (select " + ", ".join(
    f"quantile_cont(cast({c} as double),0.5) m_{c}" for c in NUM + ENG) + " from ftr), mo as (select " + ", ".join(
    f"(select v from (select cast({c} as varchar) v, count(*) k from ftr where {c} is not null group by 1) order by k desc, v limit 1) o_{c}" for c in CAT + ENGCAT) + " from (select 1))"


def codes(c):
    return f"""coalesce((select cast(rn as int) from (select v, row_number() over (order by v)-1 rn from (select distinct cast({c} as varchar) v from ftr where {c} is not null))
      where v=coalesce(cast(ft.{c} as varchar), o_{c})), -1) {c}"""


SQL = {
    "stratified_split": q(LINES, "select case when split='test' then 'test' else 'train' end split, PurchaseStatus as label, count(*) row_count from lp group by 1,2"),
    "stratified_split_exact": q(CLEAN, """select row_id, case when rn<=round(k*0.2e0) then 'test' else 'train' end split from
      (select row_id, row_number() over (partition by PurchaseStatus order by md5(concat(row_id,':42')), row_id) rn, count(*) over (partition by PurchaseStatus) k from cd)"""),
    "nested_split": q(LINES, "select split, PurchaseStatus as label, count(*) row_count from lp group by 1,2"),
    "split_distribution": q(CLEAN, """select split, PurchaseStatus as label, count(*) row_count,
      round(count(*)/sum(count(*)) over (partition by split),6) rate from cd group by 1,2"""),
    "fold_assignment": q(CLEAN, "select row_id, cast(cast(('0x'||substr(md5(concat(row_id,':42:fold')),1,8)) as bigint)%4 as int) fold from cd where split<>'test'"),
    "sample_rows": q(LINES, "select row_id, Age, PurchaseStatus from lp order by md5(concat(row_id,':42:sample')), row_id limit 60"),
    "class_weights": q(LINES, """select PurchaseStatus as label, count(*) class_count, round(sum(count(*)) over ()/(count(*) over ()*count(*)),6) weight
      from lp where split='train' group by 1"""),
    "engineered_features": q(FEATURES, f"select row_id, {', '.join(ENGCAT)}, round(income_per_purchase_proxy,6) income_per_purchase_proxy, "
                             "round(loyalty_time_interaction,6) loyalty_time_interaction, high_time_low_history_flag, non_loyal_high_time_flag from ft"),
    "imputed": q(MATRIX, "select row_id, " + ", ".join(f"coalesce(cast({c} as double), m_{c}) {c}" for c in NUM) + ", "
                 + ", ".join(f"coalesce(cast({c} as varchar), o_{c}) {c}" for c in CAT) + " from ft, md, mo"),
    "standardized": q(MATRIX, " union all ".join(f"""select '{c}' column_name, count(*) row_count, round(avg((x-a)/s)+0e0,6)+0e0 mean_value, round(stddev_pop((x-a)/s),6) std_value
      from (select coalesce(cast({c} as double), m_{c}) x from ft, md where split='test'),
      (select avg(coalesce(cast({c} as double), m_{c})) a, coalesce(nullif(stddev_pop(coalesce(cast({c} as double), m_{c})),0),1) s from ftr, md)""" for c in NUM + ENG)),
    "one_hot": q(MATRIX, " union all ".join(f"""select '{c}' column_name, case when v in (select distinct cast({c} as varchar) from ftr where {c} is not null) then v else '(unknown)' end "level",
      count(*) row_count from (select coalesce(cast({c} as varchar), o_{c}) v from ft, mo where split='test') group by 2""" for c in CAT + ENGCAT)),
    "ordinal_encoded": q(MATRIX, f"select row_id, {', '.join(codes(c) for c in CAT + ENGCAT)} from ft, mo where split='test'"),
    "matrix_checks": q(MATRIX, "select split frame_name, count(*) row_count, cast(8 + " + " + ".join(
        f"(select count(distinct {c}) from ftr)" for c in CAT + ENGCAT) + " as int) feature_count, cast(0 as bigint) null_cells from ft group by split"),
    "baseline_prior": q(LINES, """select round(prior,6) p, cast(case when prior>0.5 then 1 else 0 end as int) yhat, count(*) row_count
      from lp, (select avg(PurchaseStatus) prior from lp where split='train') group by 1,2"""),
    "baseline_random": q(LINES, """select cast(h as double) p, h yhat, count(*) row_count from (select cast(case when
      cast(cast(('0x'||substr(md5(concat(row_id,':42:draw')),1,6)) as int) as double)/16777216e0 < prior then 1 else 0 end as int) h
      from lp, (select avg(PurchaseStatus) prior from lp where split='train')) group by 1,2"""),
    "rule_baseline_score": q(RULED, "select p, yhat, count(*) row_count from ru group by 1,2"),
    "scorecard": q(SCORED, "select row_id, p, yhat from sc"),
    "scorecard_drivers": q(LINES, """select array_to_string(list_transform(list_slice(list_sort([
      {'k': -abs(case when LoyaltyProgram=1 then 1.55e0 else 0e0 end), 'i': 0, 'n': 'LoyaltyProgram'},
      {'k': -abs(((cast(TimeSpentOnWebsite as double)-1e0)/59e0)*1.1e0), 'i': 1, 'n': 'TimeSpentOnWebsite'},
      {'k': -abs(((cast(NumberOfPurchases as double)-0e0)/20e0)*1.05e0), 'i': 2, 'n': 'NumberOfPurchases'},
      {'k': -abs(((cast(AnnualIncome as double)-20000e0)/130000e0)*0.55e0), 'i': 3, 'n': 'AnnualIncome'},
      {'k': -abs((1e0-(cast(Age as double)-18e0)/52e0)*0.45e0), 'i': 4, 'n': 'Age'},
      {'k': -abs(case ProductCategory when 0 then -0.05e0 when 1 then 0.03e0 when 2 then 0.01e0 when 3 then 0.05e0 else 0e0 end), 'i': 5, 'n': 'ProductCategory'},
      {'k': -0.01e0, 'i': 6, 'n': 'Gender'}]), 1, 3), lambda s: s.n), '|') drivers, count(*) row_count from lp group by 1"""),
    "score_discount": q(SCORED, """select s score_percent, case when s>=75 then 0e0 else round(ceil((75-s)/2e0)/100e0,2) end discount_rate, count(*) row_count
      from (select cast(least(greatest(floor(p*100+0.5e0),0),100) as int) s from sc) group by 1,2"""),
    "classifier_metrics": q(MODELS, "select * from mm"),
    "roc_auc": q(SC + evaluate("sy", ["split"]), "select split, roc_auc from m"),
    "average_precision": q(SC + evaluate("sy", ["split"]), "select split, pr_auc from m"),
    "pr_curve": q(SC + ", st as (select * from sy where split='test')" + evaluate("st", []),
                  """select p threshold, round(coalesce(cp_/nullif(cp_+cn_,0),0e0),6) "precision", round(cp_/(select sum(pos) from lad),6) recall from cum"""),
    "calibration_curve": q(SC + ", st as (select p, y from sy where split='test')" + calibration("st", []), "select * from cal"),
    "threshold_metrics": q(SC + f", cc as (select 0.5e0 threshold, {cells('0.5e0')} from sy)", cell_metrics("cc")),
    "threshold_sweep": q(SC + sweep("sy"), "select * from sw"),
    "optimal_threshold": q(SC + ", va as (select * from sy where split='validation')" + sweep("va"), "select * from best"),
    "decision_bands": q(SC + ", va as (select * from sy where split='validation')" + sweep("va"), "select * from bands"),
    "threshold_transfer": q(RULED + ", ry as (select *, PurchaseStatus y from ru), va as (select * from ry where split='validation')" + sweep("va")
                            + f", cc as (select best.threshold, {cells('best.threshold')} from ry, best where split='test' group by best.threshold)", cell_metrics("cc")),
    "intent_band_summary": q(SC + ", va as (select * from sy where split='validation')" + sweep("va"), """select case when p<low_action_threshold then 'low_intent_holdout'
      when p<high_confidence_no_discount_threshold then 'mid_band_targeted_offer' else 'high_confidence_no_discount' end policy_band, count(*) row_count,
      round(avg(y),6) observed_purchase_rate, round(avg(p),6) average_probability, round(count(*)/sum(count(*)) over (),6) "share"
      from sy, bands where split='test' group by 1"""),
    "calibration_followup": q(MODELS, "select model_name, calibration_gap, brier_score from mm where model_name in ('rule_based_baseline','scorecard') and (calibration_gap>0.05 or brier_score>0.2)"),
    "segment_performance": q(SC + segments(True) + evaluate("sg", ["segment_name", "segment_value"], True), f"select {SLICE} from m where row_count>=20"),
    "cv_summary": q(SC + ", fo as (select *, cast(cast(('0x'||substr(md5(concat(row_id,':42:fold')),1,8)) as bigint)%4 as int) fold from sy where split<>'test')" + evaluate("fo", ["fold"]),
                    " union all ".join(f"""select '{n}' metric_name, round(avg({n}),6) mean_value, round(stddev_pop({n}),6) std_value,
                      string_agg(printf('%.6f', {n}), '|' order by fold) fold_scores from m""" for n in ("pr_auc", "balanced_accuracy", "roc_auc"))),
    "recommend_baseline": q(mapped({"rule_based_baseline": "logistic_regression", "scorecard": "decision_tree"}) + """,
      tp_ as (select * from cm order by balanced_accuracy desc, coalesce(roc_auc,-1) desc, brier_score limit 1), rf as (select * from cm where nm='logistic_regression'),
      de as (select tp_.nm tn_, tp_.balanced_accuracy-rf.balanced_accuracy<=0.02 and tp_.roc_auc-rf.roc_auc<=0.02 and rf.brier_score-tp_.brier_score<=0.02 cl from tp_, rf)""",
      "select case when cl then 'logistic_regression' else tn_ end recommended_model, cl and tn_<>'logistic_regression' simpler_preferred from de"),
    "recommend_strategy": q(mapped({"random_baseline": "logistic_reference", "rule_based_baseline": "logistic_class_weight", "scorecard": "smote_logistic"}) + """,
      tp_ as (select * from cm order by coalesce(pr_auc,-1) desc, recall desc, balanced_accuracy desc, "precision" desc limit 1),
      rf as (select * from cm where nm='logistic_reference'), wt as (select * from cm where nm='logistic_class_weight')""",
      """select case when tp_.pr_auc-rf.pr_auc<=0.02 and tp_.balanced_accuracy-rf.balanced_accuracy<=0.02 then 'logistic_reference'
      when tp_.nm like 'smote%' and tp_.pr_auc-wt.pr_auc<=0.015 and tp_.balanced_accuracy-wt.balanced_accuracy<=0.02 then 'logistic_class_weight'
      else tp_.nm end recommended_strategy, tp_.nm strongest_strategy from tp_, rf, wt"""),
    "model_ranking": q(MODELS, """select model_name, cast(row_number() over (order by coalesce(pr_auc,-1) desc, coalesce(balanced_accuracy,-1) desc, coalesce(roc_auc,-1) desc, brier_score,
      calibration_gap, model_name) as int) "rank" from mm"""),
    "choose_variant": q(mapped({"scorecard": "base", "rule_based_baseline": "sigmoid_calibrated"}), """select case when (c.pr_auc>=b.pr_auc+0.005 and c.brier_score<=b.brier_score+0.01)
      or (c.pr_auc+0.01>=b.pr_auc and c.brier_score+0.005<b.brier_score and c.calibration_gap<=b.calibration_gap) then 'sigmoid_calibrated' else 'base' end selected_variant
      from (select * from cm where nm='base') b, (select * from cm where nm='sigmoid_calibrated') c"""),
    "champion_challenger": q(mapped({"random_baseline": "random_forest", "scorecard": "gradient_boosting", "rule_based_baseline": "hist_gradient_boosting"}) + """,
      rk as (select *, case nm when 'random_forest' then 0 when 'hist_gradient_boosting' then 1 else 2 end cx, row_number() over (order by coalesce(pr_auc,-1) desc,
        coalesce(balanced_accuracy,-1) desc, coalesce(roc_auc,-1) desc, brier_score, calibration_gap, nm) r from cm),
      sw_ as (select a.nm an, b.nm bn, a.pr_auc-b.pr_auc<=0.01 and a.balanced_accuracy-b.balanced_accuracy<=0.01 and b.cx<a.cx s from rk a, rk b where a.r=1 and b.r=2)""",
      "select case when s then bn else an end champion, case when s then an else bn end challenger, s swapped from sw_"),
    "fairness_metrics": q(FAIR, "select * from fm"),
    "fairness_gaps": q(FAIR, "select * from gp"),
    "fairness_alerts": q(FAIR, "select segment_name, segment_value, metric_name, gap_value from gp where gap_value>=0.12"),
    "fairness_top": q(FAIR, """select segment_name, segment_value, coalesce(max(case when metric_name='recall' then gap_value end),0) recall_gap,
      coalesce(max(case when metric_name='false_positive_rate' then gap_value end),0) false_positive_rate_gap from gp group by 1,2
      order by greatest(recall_gap, false_positive_rate_gap) desc, segment_name, segment_value limit 8"""),
}
