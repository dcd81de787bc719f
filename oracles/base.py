"""Common table expressions of the oracle queries."""

COLS = "Age, Gender, AnnualIncome, NumberOfPurchases, ProductCategory, TimeSpentOnWebsite, LoyaltyProgram, DiscountsAvailed, PurchaseStatus"

CUSTOMERS = """
o_ as (select o_custkey,
    count(case when o_orderdate < timestamp '2001-04-01' then 1 end) n_orders,
    count(case when o_orderdate < timestamp '2001-04-01' and o_orderpriority='1-URGENT' then 1 end) n_urgent,
    max(case when o_orderdate >= timestamp '2001-04-01' then 1 else 0 end) y
  from orders group by o_custkey),
l_ as (select o_custkey, avg(l_quantity) q, count(case when l_discount >= 0.09 then 1 end) d
  from lineitem join orders on l_orderkey=o_orderkey
  where o_orderdate < timestamp '2001-04-01' group by o_custkey),
p_ as (select c_custkey profile_id, cast(18+c_custkey%53 as int) Age, cast(c_custkey%2 as int) Gender,
    c_acctbal AnnualIncome, cast(coalesce(o_.n_orders,0) as int) NumberOfPurchases,
    cast(case c_mktsegment when 'AUTOMOBILE' then 0 when 'BUILDING' then 1 when 'FURNITURE' then 2
                      when 'HOUSEHOLD' then 3 else 4 end as int) ProductCategory,
    round(l_.q,6) TimeSpentOnWebsite, cast(case when coalesce(o_.n_urgent,0)>=3 then 1 else 0 end as int) LoyaltyProgram,
    cast(least(5,coalesce(l_.d,0)) as int) DiscountsAvailed, cast(coalesce(o_.y,0) as int) PurchaseStatus
  from customer left join o_ on o_.o_custkey=c_custkey left join l_ on l_.o_custkey=c_custkey),
cp as (select * from p_ union all select * from p_ where profile_id%14=0)"""

ROW_ID = """md5(concat(coalesce(cast(Age as varchar),''),':',coalesce(cast(Gender as varchar),''),':',
  coalesce(cast(cast(round(AnnualIncome*100) as bigint) as varchar),''),':',coalesce(cast(NumberOfPurchases as varchar),''),':',
  coalesce(cast(ProductCategory as varchar),''),':',coalesce(cast(cast(round(TimeSpentOnWebsite*1000000) as bigint) as varchar),''),':',
  coalesce(cast(LoyaltyProgram as varchar),''),':',coalesce(cast(DiscountsAvailed as varchar),''),':',
  coalesce(cast(PurchaseStatus as varchar),'')))"""


def split_case(key="row_id"):
    return (f"case when substr(md5(concat({key},':42')),1,8) < '33333333' then 'test' "
            f"when substr(md5(concat({key},':42:inner')),1,8) < '33333333' then 'validation' else 'train' end")


CLEAN = CUSTOMERS + f""",
cd0 as (select min(profile_id) profile_id, {COLS} from cp group by all),
cd1 as (select *, {ROW_ID} row_id from cd0),
cd as (select *, {split_case()} split from cd1)"""

LINES = f"""
lp0 as (select md5(concat(l_orderkey,':',l_linenumber,':',l_partkey,':',l_suppkey,':',cast(round(l_extendedprice*100) as bigint))) row_id,
    cast(18 + l_partkey % 53 as int) Age, cast(l_suppkey % 2 as int) Gender, l_extendedprice AnnualIncome,
    cast(l_orderkey % 21 as int) NumberOfPurchases, cast(l_partkey % 5 as int) ProductCategory,
    l_quantity TimeSpentOnWebsite, cast(case when l_linestatus='F' then 1 else 0 end as int) LoyaltyProgram,
    cast(floor(l_discount*50 + 1e-9) as int) DiscountsAvailed from lineitem),
lp1 as (select *, cast(cast(('0x'||substr(row_id,1,6)) as int) as double)/16777216e0 u from lp0),
lp2 as (select * exclude (u), cast(case when 0.45e0*LoyaltyProgram + 0.35e0*(case when NumberOfPurchases>=10 then 1 else 0 end)
    + 0.20e0*(case when TimeSpentOnWebsite>=25 then 1 else 0 end) + 0.6e0*(u-0.5e0) >= 0.55e0 then 1 else 0 end as int) PurchaseStatus from lp1),
lp as (select *, {split_case()} split from lp2)"""


def scorecard(src, dst):
    """Scorecard probability (6 decimals) and its label."""
    t = "((cast(TimeSpentOnWebsite as double)-1e0)/59e0)"
    n = "((cast(NumberOfPurchases as double)-0e0)/20e0)"
    i = "((cast(AnnualIncome as double)-20000e0)/130000e0)"
    a = "(1e0-(cast(Age as double)-18e0)/52e0)"
    return f""",
{dst}_raw as (select *, -2.45e0 + (case when LoyaltyProgram=1 then 1.55e0 else 0e0 end) + {t}*1.1e0 + {n}*1.05e0 + {i}*0.55e0 + {a}*0.45e0
   + (case ProductCategory when 0 then -0.05e0 when 1 then 0.03e0 when 2 then 0.01e0 when 3 then 0.05e0 else 0e0 end)
   + (case when Gender=1 then 0.01e0 else -0.01e0 end)
   + (case when {t}>0.72e0 and {a}>0.8e0 then 0.9e0 else 0e0 end)
   + (case when {t}>0.72e0 and {n}<0.2e0 then 0.14e0 else 0e0 end)
   + (case when LoyaltyProgram=1 and {n}>0.7e0 then 0.22e0 else 0e0 end) raw_score from {src}),
{dst}_p as (select * exclude (raw_score),
   case when raw_score is not null then round(least(greatest(1e0/(1e0+exp(-raw_score)),0.015e0),0.985e0),6) end p from {dst}_raw),
{dst} as (select *, cast(case when p>=0.3e0 then 1 else 0 end as int) yhat from {dst}_p)"""


SCORED = LINES + scorecard("lp", "sc")

RULED = LINES + """,
med as (select quantile_cont(cast(NumberOfPurchases as double),0.5) mp, quantile_cont(cast(TimeSpentOnWebsite as double),0.5) mt from lp where split='train'),
ru0 as (select lp.*, round(least(greatest(0.45e0*least(greatest(coalesce(cast(LoyaltyProgram as double),0e0),0e0),1e0)
   + 0.35e0*(case when coalesce(cast(NumberOfPurchases as double),mp)>=mp then 1e0 else 0e0 end)
   + 0.2e0*(case when coalesce(TimeSpentOnWebsite,mt)>=mt then 1e0 else 0e0 end),0e0),1e0),6) p from lp, med),
ru as (select *, cast(case when p>=0.5e0 then 1 else 0 end as int) yhat from ru0)"""


def q(ctes, body):
    return f"with {ctes.strip()}\n{body.strip()}"
