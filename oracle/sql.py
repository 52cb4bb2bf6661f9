"""DuckDB SQL for the registered queries.

Written row by row in the plainest form (joins first, ``qualify`` for row picks, no
pre-aggregation), so that it checks the results and not the plans.
"""

from __future__ import annotations


def r(expression: str, digits: int = 2) -> str:
    """Half-up rounding on the shortest decimal form of a double, as a double."""
    return f"round(({expression})::double::varchar::decimal(38,17), {digits})::double"


def total(expression: str) -> str:
    return f"round(sum(({expression})::decimal(38,10)), 2)::double"


def mean(expression: str) -> str:
    return f"(sum(({expression})::decimal(38,10))::double / nullif(count({expression}), 0))"


def times(condition: str) -> str:
    return f"sum(case when {condition} then 1 else 0 end)::bigint"


def case(name: str, marks: list[str] | None = None) -> str:
    """The labels of one rule set; ``marks`` go in front of them, in order, default last."""
    *rules, (_, default) = RULES[name]
    *fronts, last = marks or [""] * len(RULES[name])
    branches = [
        f"when {condition} then {literal(label, front)}"
        for (condition, label), front in zip(rules, fronts)
    ]
    return f"case {' '.join(branches)} else {literal(default, last)} end"


def literal(label: object, front: str) -> str:
    return f"'{front}{label}'" if isinstance(label, str) else str(label)


# Conditions and labels, first match first, the default last.
RULES: dict[str, list[tuple[str, object]]] = {
    "health": [
        ("net_income < 0", "Unprofitable"),
        ("debt_to_equity > 2.5", "High Leverage Risk"),
        ("profit_margin_pct < 5", "Low Margin"),
        ("profit_margin_pct > 15 and debt_to_equity < 1.5", "Strong"),
        ("", "Healthy"),
    ],
    "signal": [
        ("fe_num_est < 3", "Low Coverage - Limited Data"),
        ("(fe_high - fe_low) / nullif(fe_mean, 0) > 0.5", "High Uncertainty - Divergent Views"),
        ("fe_mean > 0", "Positive Outlook - Profitable Expected"),
        ("", "Negative Outlook - Losses Expected"),
    ],
    "recommendation": [
        ("net_income < 0", "SELL - Company Unprofitable"),
        ("debt_to_equity > 2.5", "SELL - Excessive Leverage Risk"),
        ("growth < -0.15", "SELL - Declining Earnings Expected"),
        ("growth > 0.20", "STRONG BUY - High Growth Expected"),
        ("growth > 0.05", "BUY - Positive Growth Expected"),
        ("growth > -0.10", "HOLD - Flat Growth"),
        ("", "HOLD - Monitor Closely"),
    ],
    "level": [
        ("net_income < 0 or debt_to_equity > 2.5", "High Risk"),
        ("profit_margin_pct < 3 or debt_to_equity > 1.5", "Medium Risk"),
        ("", "Low Risk"),
    ],
    "rating": [
        ("w > 0.30", "HIGH RISK - Consider Rebalancing"),
        ("w > 0.15", "MEDIUM RISK - Monitor Closely"),
        ("g > 10 and m > 10", "EXCELLENT - Strong Growth Portfolio"),
        ("", "HEALTHY - Well Positioned"),
    ],
    "risk": [
        ("net_income < 0", "High Risk - Unprofitable"),
        ("debt_to_equity > 2.5", "High Risk - Excessive Debt"),
        ("growth < -0.15", "Medium Risk - Declining Earnings"),
        ("profit_margin_pct < 3", "Medium Risk - Low Margins"),
        ("profit_margin_pct > 15 and debt_to_equity < 1.5", "Low Risk - Strong Fundamentals"),
        ("", "Low Risk"),
    ],
    "action": [
        ("net_income < 0", "SELL - Company Losing Money"),
        ("growth < -0.15", "SELL - Earnings Declining"),
        ("growth > 0.20", "STRONG BUY - High Growth Expected"),
        ("growth > 0.05", "BUY - Positive Growth"),
        ("growth > -0.10", "HOLD - Stable"),
        ("", "HOLD - Monitor"),
    ],
    "priority": [
        ("action like '%SELL%'", "URGENT - Consider Selling"),
        ("risk like '%High%'", "REVIEW - High Risk"),
        ("growth_pct > 25", "OPPORTUNITY - Strong Growth"),
        ("action like '%STRONG BUY%'", "OPPORTUNITY - Consider Buying More"),
        ("", "MONITOR - Stable"),
    ],
    "rank": [
        ("action like '%SELL%'", 1),
        ("risk like '%High%'", 2),
        ("growth_pct > 25", 3),
        ("", 4),
    ],
    "category": [
        ("risk like '%High%'", "High Risk"),
        ("risk like '%Medium%'", "Medium Risk"),
        ("", "Low Risk"),
    ],
    "group": [
        ("action like '%STRONG BUY%'", "Strong Buy"),
        ("action like '%BUY%'", "Buy"),
        ("action like '%SELL%'", "Sell"),
        ("", "Hold"),
    ],
    "tier": [
        ("growth_pct > 15", "Top Performer"),
        ("growth_pct > 5", "Above Average"),
        ("growth_pct > -5", "Stable"),
        ("", "Underperformer"),
    ],
    "leverage": [
        ("debt_to_equity_ratio > 2", "High Risk"),
        ("debt_to_equity_ratio > 1", "Medium Risk"),
        ("", "Low Risk"),
    ],
    "leverage_action": [
        ("growth_pct > 15 and debt_to_equity_ratio < 1", "Strong Buy"),
        ("growth_pct > 10", "Buy More"),
        ("growth_pct < -10", "Consider Selling"),
        ("debt_to_equity_ratio > 2", "Review - High Debt"),
        ("", "Hold"),
    ],
    "growth": [
        ("growth > 0.15", "Strong Buy"),
        ("growth > 0.05", "Buy"),
        ("growth > -0.05", "Hold"),
        ("", "Sell"),
    ],
}

AS_OF = "date '2000-06-30'"
SINCE = "date '1998-01-01'"

# Logical tables.

TABLES = {
    "equity_holdings": """
        select case p_type when 'ECONOMY' then 'Fund' else 'Equity' end as instrument_type,
               'p' || p_partkey || '-us' as symbol,
               sum(l_quantity::decimal(18,2))::double as number_of_shares
        from lineitem join part on l_partkey = p_partkey
        group by p_partkey, p_type""",
    "customer_holdings": """
        select o_custkey as customer_id,
               'P' || l_partkey as ticker_symbol,
               l_quantity::decimal(18,2) as shares_held,
               o_orderdate::date as purchase_date,
               round((l_extendedprice / l_quantity)::decimal(18,6), 2)::decimal(18,2) as cost_basis,
               case when o_orderpriority like '1%' then 'IRA'
                    when o_orderpriority like '2%' then '401k'
                    else 'Brokerage' end as account_type
        from lineitem join orders on l_orderkey = o_orderkey""",
    "sym": """
        select 'P' || p_partkey || '-US' as ticker_region, 'S' || p_partkey || '-R' as fsym_id
        from part where p_partkey % 10 <> 7""",
    "sec_map": """
        select 'S' || p_partkey || '-R' as fsym_id,
               'C' || (p_partkey % (select count(*) from supplier)) || '-E' as fsym_company_id
        from part where p_partkey % 10 <> 3""",
    "fe_sec_map": """
        select 'S' || p_partkey || '-R' as fsym_id,
               'C' || (p_partkey % (select count(*) from supplier)) || '-E' as fsym_company_id
        from part where p_partkey % 10 <> 3 and p_partkey % 9 <> 4""",
    "yearly": """
        select l_suppkey as sk, year(l_shipdate) as yr,
               sum(l_extendedprice::decimal(18,2))::double as sales
        from lineitem
        group by all""",
    "ff": """
        select 'C' || sk || '-E' as fsym_id,
               make_date(yr, 12, 31) as fiscal_date,
               sales as ff_sales,
               sales * ((7 * sk + 3 * yr) % 41 - 8) / 100e0 as ff_net_income,
               sales * ((7 * sk + 3 * yr) % 41 - 8) / 10000000e0 as ff_eps_basic,
               sales * 1.2e0 as ff_assets,
               sales * 0.4e0 as ff_gross_inc,
               case when sk % 25 = 1 then 0e0 else sales * 0.5e0 end as ff_com_eq,
               sales * ((sk + yr) % 31 - 5) / 100e0 as ff_funds,
               case when sk % 37 = 2 then null else sales * ((3 * sk) % 10) / 20e0 end as ff_debt_st,
               sales * ((5 * sk + yr) % 21) / 20e0 as ff_debt_lt
        from yearly""",
    "fe": """
        with base as (
            select sk, yr + 1 as fy, sales * ((7 * sk + 3 * yr) % 41 - 8) / 10000000e0 as eps
            from yearly
        ), estimate as (
            select *, eps * (1e0 + ((11 * sk + fy) % 61 - 25) / 100e0) * k as m
            from base,
                 (values ('EPS', 1e0), ('SALES', 1000e0)) i(item, k),
                 (values (1), (2)) v(rev)
        )
        select 'C' || sk || '-E' as fsym_id, item as fe_item, make_date(fy, 12, 31) as fe_fp_end,
               m as fe_mean, m * 0.99e0 as fe_median,
               m * (1e0 + (sk % 8) / 20e0) as fe_high, m * (1e0 - (sk % 8) / 20e0) as fe_low,
               abs(eps) * (sk % 8) / 40e0 as fe_std_dev, ((13 * sk) % 25)::int as fe_num_est,
               case rev when 1 then date '1999-12-15' end as cons_end_date
        from estimate""",
    "coverage": """
        select 'P' || p_partkey as ticker, fsym_company_id as entity_id, p_name as proper_name,
               'EQY' as entity_type, 'US' as iso_country
        from part
        join sym on ticker_region = 'P' || p_partkey || '-US'
        join sec_map using (fsym_id)""",
    "entity_facts": """
        select fsym_id as entity_id, year(fiscal_date)::int as fiscal_year, ff_sales as sales,
               ff_net_income as net_income, ff_assets as total_assets, ff_com_eq as total_equity,
               ff_eps_basic as eps_basic
        from ff""",
    "entity_eps": """
        select fsym_id as entity_id, year(fe_fp_end)::int as fiscal_year, fe_mean as mean_estimate,
               fe_high as high_estimate, fe_low as low_estimate, fe_num_est as num_estimates,
               fe_std_dev as standard_deviation
        from fe where fe_item = 'EPS' and cons_end_date is null""",
    "annual_financials": """
        select ticker, fiscal_year, sales as revenue, net_income
        from coverage join entity_facts using (entity_id)""",
}

def article(estimates: str) -> str:
    """The article's dashboard over one relation of estimates per ticker. Its formulas."""
    return f"""
        select * exclude (growth_pct),
               {case('leverage')} as risk_assessment,
               {case('leverage_action')} as action_recommendation
        from (select *, projected_eps_growth_pct as growth_pct from (
            select symbol, number_of_shares as shares_held, instrument_type, fiscal_date,
                   ff_eps_basic as eps_current, ff_net_income as net_income, ff_sales as revenue,
                   ff_gross_inc as gross_income,
                   number_of_shares * ff_eps_basic as my_current_annual_earnings,
                   forward_eps as consensus_eps_estimate,
                   number_of_shares * forward_eps as my_projected_annual_earnings,
                   case when ff_eps_basic > 0
                        then (forward_eps - ff_eps_basic) / ff_eps_basic * 100e0
                        end as projected_eps_growth_pct,
                   case when ff_debt_lt > 0 and ff_com_eq > 0
                        then ff_debt_lt / ff_com_eq end as debt_to_equity_ratio
            from equity_holdings
            join sym on upper(symbol) = sym.ticker_region
            join sec_map on sym.fsym_id = sec_map.fsym_id
            join ff on ff.fsym_id = sec_map.fsym_company_id
            left join {estimates} e on e.ticker_region = sym.ticker_region))"""


# Shared steps.

GROWTH = "(forward_eps - current_eps) / nullif(current_eps, 0)"

STEPS = {
    "held": """
        select symbol, upper(symbol) as ticker_region, number_of_shares as shares_held, instrument_type
        from equity_holdings where instrument_type = 'Equity'""",
    "reported": f"""
        select ticker_region, fiscal_date, ff_sales as revenue, ff_net_income as net_income,
               ff_eps_basic as current_eps, ff_funds as operating_cash_flow,
               {r("ff_net_income / nullif(ff_sales, 0) * 100e0")} as profit_margin_pct,
               {r("ff_funds / nullif(ff_sales, 0) * 100e0")} as cash_flow_margin_pct,
               {r("ff_com_eq / nullif(ff_assets, 0) * 100e0")} as equity_ratio_pct,
               (ff_debt_st + ff_debt_lt) / nullif(ff_com_eq, 0) as leverage,
               {r("(ff_debt_st + ff_debt_lt) / nullif(ff_com_eq, 0)")} as debt_to_equity
        from sym
        join sec_map on sym.fsym_id = sec_map.fsym_id
        join ff on ff.fsym_id = sec_map.fsym_company_id
        where fiscal_date >= {SINCE}
        qualify row_number() over (partition by ticker_region order by fiscal_date desc) = 1""",
    "expected": f"""
        select ticker_region, fe_fp_end as next_period, fe_mean as forward_eps,
               fe_num_est as analysts,
               {r("(fe_high - fe_low) / nullif(fe_mean, 0) * 100e0")} as spread_pct
        from sym
        join fe_sec_map on sym.fsym_id = fe_sec_map.fsym_id
        join fe on fe.fsym_id = fe_sec_map.fsym_company_id
        where fe_item = 'EPS' and cons_end_date is null and fe_fp_end >= {AS_OF}
        qualify row_number() over (partition by ticker_region order by fe_fp_end) = 1""",
    "profile": f"""
        select reported.*, next_period, forward_eps, analysts, spread_pct,
               {GROWTH} as growth,
               {r(f"({GROWTH}) * 100e0")} as growth_pct
        from reported left join expected using (ticker_region)""",
    "dashboard": f"""
        select symbol, shares_held, fiscal_date as latest_fiscal_date,
               {r("revenue / 1000000e0")} as revenue_mm,
               {r("net_income / 1000000e0")} as net_income_mm,
               {r("operating_cash_flow / 1000000e0")} as operating_cf_mm,
               profit_margin_pct, cash_flow_margin_pct, debt_to_equity as debt_to_equity_ratio,
               equity_ratio_pct, current_eps, forward_eps, next_period as next_estimate_period,
               analysts as num_analysts_covering, spread_pct as analyst_disagreement_pct,
               {r("shares_held * current_eps")} as my_current_annual_earnings,
               {r("shares_held * forward_eps")} as my_projected_annual_earnings,
               {r("shares_held * (forward_eps - current_eps)")} as my_expected_earnings_increase,
               growth_pct as projected_eps_growth_pct,
               {case('risk')} as risk_assessment,
               {case('action')} as action_recommendation
        from held join profile using (ticker_region)""",
    "rankings": f"""
        select symbol, shares_held, my_current_annual_earnings as annual_earnings_contribution,
               projected_eps_growth_pct as growth_rate, profit_margin_pct, debt_to_equity_ratio,
               num_analysts_covering,
               {r('''(case when projected_eps_growth_pct > 0
                           then least(projected_eps_growth_pct, 30e0) else 0e0 end)
                   + (case when profit_margin_pct > 0 then least(profit_margin_pct, 30e0) else 0e0 end)
                   + (case when debt_to_equity_ratio < 2 then 20 else 10 end)
                   + (case when num_analysts_covering >= 10 then 20
                           else num_analysts_covering * 2 end)''', 0)} as performance_score,
               risk_assessment, action_recommendation
        from dashboard""",
    "labels": """
        select symbol as item, risk_assessment as risk, action_recommendation as action,
               projected_eps_growth_pct as growth_pct, my_current_annual_earnings
        from dashboard""",
    "risk_groups": f"""
        select {case('category')} as risk_category,
               count(*) as num_stocks,
               {total("my_current_annual_earnings")} as total_earnings,
               {r(mean("growth_pct"))} as avg_growth_rate
        from labels group by 1""",
    "action_groups": f"""
        select {case('group')} as recommendation,
               count(*) as num_stocks,
               {total("my_current_annual_earnings")} as current_earnings_impact,
               {r(mean("growth_pct"))} as avg_expected_growth
        from labels group by 1""",
    "every_estimate": """
        select ticker_region, fe_mean as forward_eps
        from sym
        join fe_sec_map on sym.fsym_id = fe_sec_map.fsym_id
        join fe on fe.fsym_id = fe_sec_map.fsym_company_id
        where fe_item = 'EPS' and cons_end_date is null""",
    "article": article("expected"),
    "article_all": article("every_estimate"),
    "article_latest": """
        select * from article
        qualify row_number() over (partition by symbol order by fiscal_date desc) = 1""",
}

PRELUDE = "with " + ",\n".join(
    f"{name} as ({body})" for name, body in {**TABLES, **STEPS}.items()
)


LISTING = """symbol, shares_held, my_current_annual_earnings, my_projected_annual_earnings,
    projected_eps_growth_pct, profit_margin_pct, debt_to_equity_ratio, num_analysts_covering,
    risk_assessment, action_recommendation"""

SUMMARY = f"""
    {total("my_current_annual_earnings")} as {{now}},
    {total("my_projected_annual_earnings")} as {{ahead}},
    {r(mean("projected_eps_growth_pct"))} as avg_growth_rate,
    {r(mean("profit_margin_pct"))} as avg_profit_margin,
    {r(mean("debt_to_equity_ratio"))} as avg_debt_to_equity,
    {times("risk_assessment like '%High%'")} as high_risk_stocks,
    {times("action_recommendation like '%SELL%'")} as {{sell}},
    {times("action_recommendation like '%BUY%'")} as {{buy}}"""

PORTFOLIO_SUMMARY = f"""
    select 'My Portfolio' as portfolio_name, count(distinct symbol) as total_holdings,
    {SUMMARY.format(now="total_current_earnings", ahead="total_projected_earnings",
                    sell="stocks_to_sell", buy="buying_opportunities")},
    {times("projected_eps_growth_pct > 20")} as high_growth_stocks
    from dashboard"""

OVERVIEW = f"""
    select 'Portfolio Health' as metric_category, count(distinct symbol) as total_stocks,
           {total("my_current_annual_earnings")} as total_annual_earnings,
           {total("my_projected_annual_earnings")} as projected_annual_earnings,
           {r('''(sum(my_projected_annual_earnings::decimal(38,10))::double
                  - sum(my_current_annual_earnings::decimal(38,10))::double)
                 / nullif(sum(my_current_annual_earnings::decimal(38,10))::double, 0) * 100e0''')}
               as portfolio_growth_pct,
           {r(mean("profit_margin_pct"))} as avg_profit_margin,
           {r(mean("debt_to_equity_ratio"))} as avg_leverage
    from dashboard"""

PRESSING = """(action_recommendation like '%SELL%' or action_recommendation like '%STRONG BUY%'
    or risk_assessment like '%High%' or projected_eps_growth_pct > 20)"""

TAGGED = """(select *, risk_assessment as risk, action_recommendation as action,
                 projected_eps_growth_pct as growth_pct from dashboard)"""


def action_items(extra: str = "") -> str:
    return f"""
        select {LISTING}, {case('priority')} as priority_action {extra}
        from {TAGGED} where {PRESSING}"""


STOCK_PERFORMANCE = f"""
    select symbol, shares_held, my_current_annual_earnings, my_projected_annual_earnings,
           projected_eps_growth_pct, profit_margin_pct, {case('tier')} as performance_tier
    from {TAGGED}"""


def shares(groups: str, label: str, as_name: str) -> str:
    pct = "round(num_stocks * 100e0 / sum(num_stocks) over (), 1)"
    return f"""select *, {pct} as pct_of_portfolio,
        {label} || ': ' || num_stocks || ' stocks (' || {pct} || '%)' as {as_name}
        from {groups}"""


TRADES = """
        , priced as (
            select 'P' || l_partkey as ticker_symbol, l_returnflag = 'R' as is_sale,
                   case when l_returnflag = 'R' then l_shipdate::date else o_orderdate::date end as day,
                   l_quantity::decimal(18,2) as quantity,
                   round((l_extendedprice / l_quantity)::decimal(18,6), 2)::decimal(18,2) as price
            from lineitem left join orders on l_orderkey = o_orderkey
            where l_returnflag = 'R' or o_orderkey is not null
        ), trades as (
            select ticker_symbol, day, is_sale, price, (price * 100)::bigint as id, sum(quantity) as quantity
            from priced group by all
        )"""

GAINS = """
        met as (
            select s.ticker_symbol, s.day, s.id, l.price as cost,
                   least(s.until, l.until) - greatest(s.since, l.since) as shares
            from sale s join lot l
              on l.ticker_symbol = s.ticker_symbol and l.since < s.until and s.since < l.until
        ), covered as (
            select ticker_symbol, day, id, sum(shares) as matched, sum(shares * cost) as cost
            from met where shares > 0 group by all
        )
        select ticker_symbol, day, id, quantity::double as quantity, coalesce(matched, 0)::double as matched,
               coalesce(cost, 0)::double as cost, coalesce(matched * price, 0)::double as proceeds,
               coalesce(matched * price - cost, 0)::double as gain
        from sale left join covered using (ticker_symbol, day, id)"""

LOTS = "customer_holdings h join coverage c on h.ticker_symbol = c.ticker"
VALUE = "(shares_held * cost_basis)::double as position_value"

PERFORMANCE_SUMMARY = """
    select d.symbol, my_current_annual_earnings as current_earnings,
           my_projected_annual_earnings as projected_earnings,
           projected_eps_growth_pct as growth_rate, d.risk_assessment,
           d.action_recommendation, performance_score
    from dashboard d join rankings k on d.symbol = k.symbol"""

ARTICLE_COLUMNS = "select * exclude (fiscal_date)"

QUERIES = {
    "q01_symbology_lookup": """
        select ticker_region, fsym_id from sym
        where ticker_region in
            (select upper(symbol) from equity_holdings where instrument_type = 'Fund')""",
    "q02_mapping_chain": """
        select ticker_region, sym.fsym_id, fsym_company_id
        from sym join sec_map on sym.fsym_id = sec_map.fsym_id""",
    "q03_holdings_by_size": """
        select instrument_type, symbol, number_of_shares from equity_holdings
        where instrument_type = 'Equity' order by number_of_shares desc, symbol""",
    "q04_coverage_check": """
        select symbol, held.ticker_region, fsym_id,
               case when fsym_id is not null then 'FOUND' else 'NOT FOUND' end as status
        from held left join sym on held.ticker_region = sym.ticker_region""",
    "q05_holdings_fundamentals": f"""
        select symbol, shares_held, fiscal_date as latest_fiscal_date,
               {r("revenue / 1000000e0")} as revenue_millions,
               {r("net_income / 1000000e0")} as net_income_millions,
               current_eps as earnings_per_share,
               {r("shares_held * current_eps")} as my_share_of_earnings,
               profit_margin_pct, equity_ratio_pct, debt_to_equity,
               {r("operating_cash_flow / 1000000e0")} as operating_cf_millions,
               {case('health')} as financial_health
        from held join reported using (ticker_region)""",
    "q06_holdings_estimates": f"""
        select symbol, shares_held, fe_fp_end as fiscal_period_end, fe_mean as eps_consensus,
               fe_median as eps_median, fe_high as eps_high_estimate, fe_low as eps_low_estimate,
               fe_num_est as num_analysts,
               {r("shares_held * fe_mean")} as my_projected_earnings,
               {r("shares_held * fe_high")} as my_best_case_earnings,
               {r("shares_held * fe_low")} as my_worst_case_earnings,
               {r("fe_std_dev")} as eps_std_deviation,
               {r("(fe_high - fe_low) / nullif(fe_mean, 0) * 100e0")} as estimate_spread_pct,
               {case('signal')} as analyst_signal
        from held
        join sym on held.ticker_region = sym.ticker_region
        join fe_sec_map on sym.fsym_id = fe_sec_map.fsym_id
        join fe on fe.fsym_id = fe_sec_map.fsym_company_id
        where fe_item = 'EPS' and cons_end_date is null
          and fe_fp_end between {AS_OF} and {AS_OF} + 365""",
    "q07_investment_analysis": f"""
        select symbol, shares_held, fiscal_date as latest_fiscal_date,
               {r("revenue / 1000000e0")} as revenue_mm,
               {r("net_income / 1000000e0")} as net_income_mm, current_eps, profit_margin_pct,
               debt_to_equity, {r("operating_cash_flow / 1000000e0")} as operating_cf_mm,
               next_period as estimate_period, forward_eps, analysts as num_analysts,
               {r("shares_held * current_eps")} as my_current_earnings_share,
               {r("shares_held * forward_eps")} as my_projected_earnings_share,
               {r("shares_held * (forward_eps - current_eps)")} as my_expected_earnings_growth,
               growth_pct as eps_growth_pct,
               {case('recommendation')} as investment_recommendation,
               {case('level')} as risk_level
        from held join profile using (ticker_region)""",
    "q08_join_trace": f"""
        , chain as (
            select symbol, sym.fsym_id as step2, fsym_company_id as step3, ff.fsym_id as step4
            from held
            left join sym on held.ticker_region = sym.ticker_region
            left join sec_map on sym.fsym_id = sec_map.fsym_id
            left join ff on ff.fsym_id = fsym_company_id and fiscal_date >= {SINCE}
        ), chain3 as (
            select symbol, sym.fsym_id as step2, fsym_company_id as step3
            from held
            left join sym on held.ticker_region = sym.ticker_region
            left join sec_map on sym.fsym_id = sec_map.fsym_id
        )
        select 'Portfolio Equities' as step, count(*) as row_count,
               count(distinct symbol) as symbol_count from held
        union all
        select 'After sym_ticker_region join', count(*), count(distinct symbol)
        from held join sym on held.ticker_region = sym.ticker_region
        union all
        select 'After ff_sec_map join', count(*), count(distinct symbol)
        from chain3 where step3 is not null
        union all
        select 'After ff_basic_af join', count(*), count(distinct symbol)
        from chain where step4 is not null""",
    "q09_matched_symbols": """
        select symbol, sym.ticker_region, fsym_id
        from held join sym on held.ticker_region = sym.ticker_region""",
    "q10_portfolio_risk_summary": f"""
        , rows as (
            select *, shares_held * current_eps as now, shares_held * forward_eps as ahead
            from held join profile using (ticker_region)
        ), totals as (
            select count(distinct symbol) as total_holdings,
                   {total("now")} as total_current_annual_earnings,
                   {total("ahead")} as total_projected_annual_earnings,
                   {r('''(sum(ahead::decimal(38,10))::double - sum(now::decimal(38,10))::double)
                         / nullif(sum(now::decimal(38,10))::double, 0) * 100e0''')}
                       as portfolio_growth_rate_pct,
                   {mean("growth_pct")} as g, {mean("profit_margin_pct")} as m,
                   {r(mean("leverage"))} as avg_debt_to_equity,
                   {times("net_income < 0")} as unprofitable_companies,
                   {times("leverage > 2.5")} as high_leverage_companies,
                   {times("growth_pct < -10")} as declining_earnings_companies,
                   {times("operating_cash_flow < 0")} as negative_cash_flow_companies,
                   {times("growth_pct > 20")} as high_growth_stocks,
                   {times("profit_margin_pct > 15 and leverage < 1.5")} as quality_stocks,
                   sum(case when net_income < 0 or growth_pct < -10 then shares_held else 0 end)
                       / nullif(sum(shares_held), 0) as w
            from rows
        )
        select 'My Portfolio' as portfolio_name, * exclude (g, m, w),
               {r("g")} as avg_eps_growth_pct, {r("m")} as avg_profit_margin_pct,
               {case('rating')} as portfolio_health_rating
        from totals""",
    "q11_deep_dive": f"""
        , past as (
            select ticker_region, ff.* exclude (fsym_id) from sym
            join sec_map on sym.fsym_id = sec_map.fsym_id
            join ff on ff.fsym_id = fsym_company_id where fiscal_date >= {SINCE}
        ), future as (
            select ticker_region, fe.* exclude (fsym_id) from sym
            join fe_sec_map on sym.fsym_id = fe_sec_map.fsym_id
            join fe on fe.fsym_id = fsym_company_id
            where fe_item = 'EPS' and cons_end_date is null and fe_fp_end >= {AS_OF}
        )
        select symbol, shares_held, fiscal_date, year(fiscal_date)::int as fiscal_year,
               {r("ff_sales / 1000000e0")} as revenue_mm,
               {r("ff_net_income / 1000000e0")} as net_income_mm, ff_eps_basic as historical_eps,
               {r("ff_funds / 1000000e0")} as operating_cf_mm,
               {r("ff_net_income / nullif(ff_sales, 0) * 100e0")} as profit_margin_pct,
               {r("(ff_debt_st + ff_debt_lt) / nullif(ff_com_eq, 0)")} as debt_to_equity,
               {r("shares_held * ff_eps_basic")} as my_annual_earnings_this_year,
               fe_fp_end as estimate_period, fe_mean as forward_eps, fe_high as forward_eps_high,
               fe_low as forward_eps_low, fe_num_est as analyst_count,
               {r("shares_held * fe_mean")} as my_projected_annual_earnings,
               {r("(fe_mean - ff_eps_basic) / nullif(ff_eps_basic, 0) * 100e0")} as eps_growth_pct
        from held
        join past on held.ticker_region = past.ticker_region
        left join future on future.ticker_region = held.ticker_region""",
    "q12_portfolio_dashboard": "select * from dashboard",
    "q13_dashboard_listing": f"""
        select {LISTING} from dashboard order by my_current_annual_earnings desc, symbol""",
    "q14_dashboard_metrics": f"""
        select count(symbol) as total_positions,
        {SUMMARY.format(now="total_current_annual_earnings", ahead="total_projected_annual_earnings",
                        sell="sell_recommendations", buy="buy_opportunities")}
        from dashboard""",
    "q15_stock_by_stock": f"select {LISTING} from dashboard",
    "q16_growth_opportunities": """
        select symbol, shares_held, projected_eps_growth_pct, my_expected_earnings_increase,
               profit_margin_pct, risk_assessment, action_recommendation
        from dashboard where projected_eps_growth_pct > 10""",
    "q17_risk_alerts": """
        select symbol, shares_held, my_current_annual_earnings, projected_eps_growth_pct,
               profit_margin_pct, debt_to_equity_ratio, risk_assessment, action_recommendation
        from dashboard
        where contains(risk_assessment, 'High') or contains(action_recommendation, 'SELL')""",
    "q18_quality_stocks": """
        select symbol, profit_margin_pct, debt_to_equity_ratio, projected_eps_growth_pct,
               my_current_annual_earnings, risk_assessment
        from dashboard where profit_margin_pct > 15 and debt_to_equity_ratio < 1.5""",
    "q19_portfolio_summary": PORTFOLIO_SUMMARY,
    "q20_action_items": action_items(f", {case('rank')} as priority_rank"),
    "q21_stock_rankings": "select * from rankings",
    "q22_portfolio_overview": OVERVIEW,
    "q23_risk_distribution": "select * from risk_groups",
    "q24_action_distribution": "select * from action_groups",
    "q25_stock_performance": STOCK_PERFORMANCE,
    "q26_earnings_waterfall": """
        select symbol, my_current_annual_earnings, my_projected_annual_earnings from dashboard""",
    "q27_performance_summary": PERFORMANCE_SUMMARY,
    "q27_rankings_join": PERFORMANCE_SUMMARY,
    "q28_security_history": """
        select replace(ticker_region, '-US', '') as portfolio_ticker,
               ticker_region as ticker_region_format, sym.fsym_id as symbology_fsym_id,
               fsym_company_id as mapped_company_id, fiscal_date, ff_sales as revenue,
               ff_eps_basic as eps
        from sym
        join sec_map on sym.fsym_id = sec_map.fsym_id
        join ff on ff.fsym_id = fsym_company_id
        where fiscal_date >= date '1995-01-01'
        qualify row_number() over (partition by ticker_region order by fiscal_date desc) <= 3""",
    "q29_leverage_dashboard": f"{ARTICLE_COLUMNS} from article",
    "q29_leverage_dashboard_all_estimates": f"{ARTICLE_COLUMNS} from article_all",
    "q29_leverage_dashboard_latest": f"{ARTICLE_COLUMNS} from article_latest",
    "q30_portfolio_fundamentals": f"""
        select customer_id, ticker_symbol, proper_name, shares_held::double as shares_held, {VALUE},
               sales as revenue, net_income, eps_basic
        from {LOTS} join entity_facts f on c.entity_id = f.entity_id
        where fiscal_year = 1999""",
    "q31_top_positions": f"""
        select customer_id, ticker_symbol, proper_name, shares_held::double as shares_held, {VALUE},
               sales as revenue, net_income, mean_estimate as eps_est
        from {LOTS}
        join entity_facts f on c.entity_id = f.entity_id and f.fiscal_year = 1999
        join entity_eps e on c.entity_id = e.entity_id and e.fiscal_year = 2000
        order by position_value desc, customer_id, ticker_symbol, shares_held, proper_name,
                 revenue, eps_est
        limit 10""",
    "q32_portfolio_estimates": f"""
        select customer_id, ticker_symbol, proper_name, shares_held::double as shares_held,
               mean_estimate as consensus_eps, high_estimate, low_estimate,
               num_estimates as analyst_count,
               shares_held::double * mean_estimate as projected_earnings
        from {LOTS} join entity_eps e on c.entity_id = e.entity_id
        where fiscal_year = 2000""",
    "q32_portfolio_outlook": f"""
        , outlook as (
            select customer_id, ticker_symbol, proper_name, {VALUE}, eps_basic as eps_actual,
                   mean_estimate as eps_estimate,
                   (mean_estimate - eps_basic) / nullif(eps_basic, 0) as growth
            from {LOTS}
            join entity_facts f on c.entity_id = f.entity_id and f.fiscal_year = 1999
            join entity_eps e on c.entity_id = e.entity_id and e.fiscal_year = 2000
        )
        select * exclude (growth), {r("growth * 100e0")} as eps_growth_pct,
               {case('growth')} as recommendation
        from outlook""",
    "q33_holdings_financials": """
        select customer_id, ticker_symbol, shares_held::double as shares_held, revenue, net_income
        from customer_holdings join annual_financials on ticker_symbol = ticker
        where fiscal_year = 1999""",
    "q33_top_investments": """
        select customer_id, ticker_symbol, (shares_held * cost_basis)::double as investment,
               revenue, net_income
        from customer_holdings join annual_financials on ticker_symbol = ticker
        where fiscal_year = 1999
        order by investment desc, customer_id, ticker_symbol, revenue, net_income
        limit 20""",
    "q33_customer_rollup": f"""
        select customer_id, count(*) as positions,
               sum(shares_held * cost_basis)::double as portfolio_value,
               {times("net_income < 0")} as risk_count
        from customer_holdings join annual_financials on ticker_symbol = ticker
        where fiscal_year = 1999
        group by customer_id""",
    "q34_unmatched_holdings": """
        select ticker_symbol, entity_id, proper_name
        from customer_holdings left join coverage on ticker_symbol = ticker
        where entity_id is null""",
    "q34_known_tickers": """
        select ticker from coverage
        where ticker in (select distinct ticker_symbol from customer_holdings)""",
    "q34_held_tickers": "select distinct ticker_symbol from customer_holdings",
    "q35_enrich_transactions": """
        select o_orderkey as transaction_id, o_custkey as customer_id, o_totalprice as amount,
               n_name as country, r_name as region
        from orders
        join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey""",
    "q36_revenue_by_category": """
        , sold as (select l_partkey, sum(l_quantity) as qty from lineitem group by l_partkey)
        select p_type as category, sum((qty * p_retailprice)::decimal(38,10))::double as revenue
        from sold join part on l_partkey = p_partkey group by p_type""",
    "q37_live_and_history": f"""
        select 'Real-Time' as source, count(*) as order_count,
               sum(o_totalprice::decimal(38,10))::double as revenue
        from orders where o_orderdate::date = {AS_OF}
        union all
        select 'Historical', count(*), sum(o_totalprice::decimal(38,10))::double
        from orders where o_orderdate::date < {AS_OF}""",
    "q38_recent_holdings": f"""
        select h.* replace (shares_held::double as shares_held, cost_basis::double as cost_basis),
               c.*
        from {LOTS} where purchase_date >= date '1999-01-01'""",
    "q39_positions_by_account": """
        select * replace (shares_held::double as shares_held, cost_basis::double as cost_basis)
        from customer_holdings where account_type = 'IRA'""",
    "q39_ticker_shares": """
        select ticker_symbol, shares_held::double as shares_held from customer_holdings""",
    "q39_customer_tickers": "select customer_id, ticker_symbol from customer_holdings",
    "q39_positions_per_ticker": """
        select ticker_symbol, count(*) as count from customer_holdings group by ticker_symbol""",
    "q40_annual_facts": "select * from entity_facts where fiscal_year = 1999",
    "q40_annual_eps": "select * from entity_eps where fiscal_year = 2000",
    "d1_portfolio_overview": OVERVIEW,
    "d2_risk_distribution": shares("risk_groups", "risk_category", "risk_label"),
    "d3_action_distribution": shares("action_groups", "recommendation", "action_label"),
    "d4_stock_performance": STOCK_PERFORMANCE,
    "d5_portfolio_summary": PORTFOLIO_SUMMARY,
    "d6_stock_rankings": """
        select * from rankings
        order by performance_score desc nulls last, annual_earnings_contribution desc nulls last,
                 symbol
        limit 15""",
    "d7_action_items": action_items(),
    "d8_top_earnings": """
        select symbol, my_current_annual_earnings as current_earnings,
               my_projected_annual_earnings as projected_earnings
        from dashboard where my_current_annual_earnings is not null
        order by my_current_annual_earnings desc, symbol limit 10""",
    "emoji_labels": f"""
        , marked as (
            select symbol, projected_eps_growth_pct as growth_pct, projected_eps_growth_pct,
                   case when risk_assessment like 'High%' then '🔴 '
                        when risk_assessment like 'Medium%' then '🟡 '
                        else '🟢 ' end || risk_assessment as risk,
                   case when action_recommendation like 'SELL%' then '❌ '
                        when action_recommendation like 'STRONG%' then '💰 '
                        when action_recommendation like 'BUY%' then '✅ '
                        when action_recommendation like '%Stable' then '⏸️ '
                        else '⚠️ ' end || action_recommendation as action,
                   coalesce({PRESSING}, false) as pressing
            from dashboard
        )
        select symbol,
               {case("tier", ["🚀 ", "📈 ", "➡️ ", "📉 "])} as performance_tier,
               case when pressing then risk end as risk_assessment,
               case when pressing then action end as action_recommendation,
               case when pressing
                    then {case("priority", ["🔴 ", "🟡 ", "🟢 ", "💰 ", "⚪ "])}
                    end as priority_action
        from marked""",
    "normalize_symbol": """
        select symbol, upper(symbol) as ticker_region from equity_holdings
        union all
        select distinct ticker_symbol, ticker_symbol || '-US' from customer_holdings""",
    "resolve": """
        select symbol, upper(symbol) as ticker_region, sym.fsym_id, fsym_company_id
        from equity_holdings
        left join sym on upper(symbol) = sym.ticker_region
        left join sec_map on sym.fsym_id = sec_map.fsym_id""",
    "latest_per_key": """
        select fsym_id, fiscal_date, ff_sales as "FF_SALES" from ff
        qualify row_number() over (partition by fsym_id order by fiscal_date desc) = 1""",
    "next_per_key": f"""
        select fsym_id, fe_item as "FE_ITEM", fe_fp_end as "FE_FP_END", fe_mean as "FE_MEAN" from fe
        where cons_end_date is null and fe_fp_end >= {AS_OF}
        qualify row_number() over (partition by fsym_id, fe_item order by fe_fp_end) = 1""",
    "current_estimates": f"""
        select fsym_id, fe_item as "FE_ITEM", fe_fp_end as "FE_FP_END", fe_mean as "FE_MEAN",
               fe_median as "FE_MEDIAN", fe_high as "FE_HIGH", fe_low as "FE_LOW",
               fe_std_dev as "FE_STD_DEV", fe_num_est as "FE_NUM_EST"
        from fe
        where fe_item = 'EPS' and cons_end_date is null
          and fe_fp_end between {AS_OF} and {AS_OF} + 365""",
    "semi_matched": """
        select symbol from equity_holdings
        where upper(symbol) in (select ticker_region from sym)""",
    "anti_unmatched": """
        select symbol from equity_holdings
        where upper(symbol) not in (select ticker_region from sym)""",
    "share_of_total": """
        , counts as (
            select account_type, count(*) as lots from customer_holdings group by account_type
        )
        select *, round(lots * 100e0 / sum(lots) over (), 1) as pct_of_portfolio,
               account_type || ': ' || lots || ' lots ('
               || round(lots * 100e0 / sum(lots) over (), 1) || '%)' as account_label
        from counts""",
    "score": "select symbol, performance_score from rankings",
    "q37_live_stream": """
        select 'Real-Time' as source, event_type, date_trunc('hour', ts) as window_start,
               count(*) as events, sum(value::decimal(38,10))::double as total
        from events where ts >= timestamp '2024-01-20' group by all
        union all
        select 'Historical', event_type, null, count(*), sum(value::decimal(38,10))::double
        from events where ts < timestamp '2024-01-20' group by all""",
    "k3_change_set": """
        , traded as (
            select 'P' || l_partkey as ticker_symbol, year(l_shipdate) as yr,
                   sum(l_quantity::decimal(18,2)) as shares, count(*) as trades
            from lineitem group by all
        ), old as (from traded where yr = 1998), new as (from traded where yr = 1999)
        select ticker_symbol,
               case when old.yr is null then 'added' when new.yr is null then 'removed' else 'changed' end as change
        from old full join new using (ticker_symbol)
        where old.yr is null or new.yr is null or old.shares <> new.shares or old.trades <> new.trades""",
    "q41_point_in_time": f"""
        , fact as (
            select ticker_region, ff.* from sym join sec_map using (fsym_id)
            join ff on ff.fsym_id = fsym_company_id
        ), revision as (
            select ticker_region, fe_fp_end, fe_mean, fe_num_est, cons_end_date
            from sym join fe_sec_map using (fsym_id) join fe on fe.fsym_id = fsym_company_id where fe_item = 'EPS'
        ), lot as (
            select *, ticker_symbol || '-US' as ticker_region
            from customer_holdings where ticker_symbol || '-US' in (select ticker_region from fact)
        ), moment as (
            select distinct ticker_region, purchase_date from lot
        ), known as (
            select m.*, f.* exclude (ticker_region, fsym_id)
            from moment m left join fact f on f.ticker_region = m.ticker_region and f.fiscal_date <= m.purchase_date
            qualify row_number() over (partition by m.ticker_region, purchase_date order by fiscal_date desc) = 1
        ), ahead as (
            select m.ticker_region, m.purchase_date, min(fe_fp_end) as next_period
            from moment m join revision v on v.ticker_region = m.ticker_region and fe_fp_end >= purchase_date
            group by all
        ), forecast as (
            select a.*, fe_mean as forward_eps, fe_num_est as analysts
            from ahead a join revision v
              on v.ticker_region = a.ticker_region and fe_fp_end = next_period
             and purchase_date < coalesce(cons_end_date, date '9999-12-31')
            qualify row_number() over (partition by a.ticker_region, purchase_date order by cons_end_date nulls last) = 1
        ), figures as (
            select ticker_region, purchase_date, fiscal_date, ff_net_income as net_income,
                   {r("ff_net_income / nullif(ff_sales, 0) * 100e0")} as profit_margin_pct,
                   {r("(ff_debt_st + ff_debt_lt) / nullif(ff_com_eq, 0)")} as debt_to_equity,
                   ff_eps_basic as current_eps, next_period, forward_eps, analysts,
                   (forward_eps - ff_eps_basic) / nullif(ff_eps_basic, 0) as growth,
                   {r("(forward_eps - ff_eps_basic) / nullif(ff_eps_basic, 0) * 100e0")} as growth_pct
            from known left join forecast using (ticker_region, purchase_date)
        )
        select customer_id, ticker_symbol, shares_held::double as shares_held, purchase_date,
               cost_basis::double as cost_basis, account_type,
               figures.* exclude (ticker_region, purchase_date, growth),
               {r("shares_held::double * current_eps")} as current_earnings,
               {r("shares_held::double * forward_eps")} as projected_earnings,
               {case('risk')} as risk_assessment, {case('action')} as action_recommendation
        from lot join figures using (ticker_region, purchase_date)""",
    "q42_security_at_date": """
        , history as (
            select 'P' || p_partkey || '-US' as ticker_region, p_partkey as p,
                   date '1995-06-01' + (p_partkey * 37 % 2000)::int as changed
            from part where p_partkey % 10 <> 7
        ), meaning as (
            select ticker_region, 'S' || p || '-R' as fsym_id, date '0001-01-01' as since, changed as until from history
            union all
            select ticker_region, 'S' || p || '-N', changed + case when p % 11 = 0 then 90 else 0 end, date '9999-12-31'
            from history
        )
        select customer_id, ticker_symbol, purchase_date, shares_held::double as shares_held, fsym_id
        from customer_holdings left join meaning
          on ticker_region = ticker_symbol || '-US' and purchase_date >= since and purchase_date < until""",
    "q43_realised_gains_fifo": f"""
        {TRADES}, trade as (
            select *, sum(case when is_sale then 0 else quantity end) over so_far as bought,
                   sum(case when is_sale then quantity else 0 end) over so_far as sold
            from trades
            window so_far as (partition by ticker_symbol order by day, is_sale, id rows unbounded preceding)
        ), deep as (
            select *, greatest(0, max(sold - bought) over (
                partition by ticker_symbol order by day, is_sale, id rows unbounded preceding)) as short
            from trade
        ), sale as (
            select *, sold - short as until,
                   coalesce(lag(sold - short) over (partition by ticker_symbol order by day, id), 0) as since
            from deep where is_sale
        ), lot as (
            select *, bought - quantity as since, bought as until from deep where not is_sale
        ), {GAINS}""",
    "q43_realised_gains_highest_cost": f"""
        {TRADES}, lot as (
            select *, until - quantity as since
            from (select *, sum(quantity) over (partition by ticker_symbol order by price desc, day, id
                                                rows unbounded preceding) as until
                  from trades where not is_sale and day < date '1999-01-01')
        ), sale as (
            select *, until - quantity as since
            from (select *, sum(quantity) over (partition by ticker_symbol order by day, id
                                                rows unbounded preceding) as until
                  from trades where is_sale and day >= date '1999-01-01')
        ), {GAINS}""",
    "q44_attribution": f"""
        , bought as (
            select ticker_symbol, account_type, year(purchase_date) as year, shares_held, cost_basis from customer_holdings
        ), price as (
            select ticker_symbol, year,
                   {r("sum(shares_held * cost_basis)::double / sum(shares_held)::double")}::decimal(18,2) as price
            from bought group by all
        ), position as (
            select account_type, b.year, p_type as category, p_brand as brand,
                   shares_held * p.price as worth, shares_held * n.price as later
            from bought b join price p using (ticker_symbol, year)
            join price n on n.ticker_symbol = b.ticker_symbol and n.year = b.year + 1
            join part on 'P' || p_partkey = b.ticker_symbol
        ), leaf as (
            select account_type, m.year, category, brand, h.worth, h.later, m.worth as m_worth, m.later as m_later
            from (select distinct account_type, year from position) a
            join (select year, category, brand, sum(worth) as worth, sum(later) as later from position group by all) m using (year)
            left join (select account_type, year, category, brand, sum(worth) as worth, sum(later) as later
                       from position group by all) h using (account_type, year, category, brand)
        ), whole as (
            select account_type, year, sum(worth) as worth, sum(m_worth) as m_worth,
                   sum(later)::double / sum(worth)::double as grown, sum(m_later)::double / sum(m_worth)::double as m_grown
            from leaf group by all
        ), linked as (
            select w.*, coalesce((select product(e.grown) from whole e
                                  where e.account_type = w.account_type and e.year < w.year), 1)
                        * coalesce((select product(l.m_grown) from whole l
                                    where l.account_type = w.account_type and l.year > w.year), 1) as carried,
                   product(grown) over (partition by account_type) - 1 as rp,
                   product(m_grown) over (partition by account_type) - 1 as rb
            from whole w
        ), rates as (
            select account_type, category, brand, carried, rp, rb, m_grown,
                   coalesce(l.worth, 0)::double / w.worth::double as share, l.m_worth::double / w.m_worth::double as m_share,
                   l.m_later::double / l.m_worth::double as seg,
                   coalesce(l.later::double / l.worth::double, l.m_later::double / l.m_worth::double) as own
            from leaf l join linked w using (account_type, year)
        ), effects as (
            select account_type, category, brand, rp, rb,
                   ((share - m_share) * (seg - m_grown) * carried)::decimal(38,10) as allocation,
                   (m_share * (own - seg) * carried)::decimal(38,10) as selection,
                   ((share - m_share) * (own - seg) * carried)::decimal(38,10) as interaction
            from rates
        )
        select account_type, category, brand,
               case when grouping(category) = 0 and grouping(brand) = 0 then 'category,brand'
                    when grouping(category) = 0 then 'category' when grouping(brand) = 0 then 'brand' else 'total' end as level,
               sum(allocation)::double as allocation, sum(selection)::double as selection,
               sum(interaction)::double as interaction,
               (sum(allocation) + sum(selection) + sum(interaction))::double as excess,
               {r("max(rp)", 8)} as portfolio_return, {r("max(rb)", 8)} as benchmark_return
        from effects
        group by grouping sets ((account_type, category, brand), (account_type, category), (account_type, brand), (account_type))""",
    "q45_sales_trends": f"""
        , quarterly as (
            select 'P' || l_partkey as ticker_symbol, (year(l_shipdate) * 4 + quarter(l_shipdate))::int as quarter,
                   sum(l_extendedprice::decimal(28,4)) as sales
            from lineitem group by all
        ), compared as (
            select q.*, sign(q.sales - b.sales)::int as direction,
                   {r("(q.sales::double - e.sales::double) / nullif(e.sales::double, 0) * 100.0")} as growth_pct
            from quarterly q
            left join quarterly b on b.ticker_symbol = q.ticker_symbol and b.quarter = q.quarter - 1
            left join quarterly e on e.ticker_symbol = q.ticker_symbol and e.quarter = q.quarter - 4
        ), islands as (
            select *, quarter - row_number() over (partition by ticker_symbol, direction order by quarter) as island
            from compared
        )
        select ticker_symbol, quarter, sales::double as sales,
               (select case when count(*) = 4 then sum(p.sales) end from quarterly p
                where p.ticker_symbol = i.ticker_symbol and p.quarter between i.quarter - 3 and i.quarter)::double as trailing,
               growth_pct, direction,
               (case when direction is null then 0
                     else row_number() over (partition by ticker_symbol, direction, island order by quarter) end)::int as streak
        from islands i""",
    "asof_price": f"""
        {TRADES}, quoted as (
            select ticker_symbol, day, min(price) as last_price from trades where is_sale group by all
        )
        select customer_id, h.ticker_symbol, shares_held::double as shares_held, purchase_date, day,
               last_price::double as last_price
        from customer_holdings h asof left join quoted q
          on q.ticker_symbol = h.ticker_symbol and q.day <= h.purchase_date""",
    "classify_coverage_status": """
        select upper(symbol) as item,
               if(sym.fsym_id is null, 'NOT FOUND', 'FOUND') as label
        from equity_holdings left join sym on upper(symbol) = ticker_region""",
    "classify_financial_health": f"""
        select ticker_region as item,
               {case('health')} as label
        from profile""",
    "classify_analyst_signal": f"""
        select fsym_id || '@' || fe_fp_end as item,
               {case('signal')} as label
        from fe where fe_item = 'EPS' and cons_end_date is null and fe_fp_end >= {AS_OF}""",
    "classify_investment_recommendation": f"""
        select ticker_region as item,
               {case('recommendation')} as label
        from profile""",
    "classify_risk_level": f"""
        select ticker_region as item,
               {case('level')} as label
        from profile""",
    "classify_portfolio_health_rating": f"""
        , weights as (
            select instrument_type,
                   sum(case when net_income < 0 or growth_pct < -10 then number_of_shares
                            else 0 end) / nullif(sum(number_of_shares), 0) as w,
                   {mean("growth_pct")} as g, {mean("profit_margin_pct")} as m
            from equity_holdings join profile on upper(symbol) = ticker_region
            group by instrument_type
        )
        select instrument_type as item,
               {case('rating')} as label
        from weights""",
    "classify_risk_assessment": f"""
        select ticker_region as item,
               {case('risk')} as label
        from profile""",
    "classify_action_recommendation": f"""
        select ticker_region as item,
               {case('action')} as label
        from profile""",
    "classify_priority_action": f"select item, {case('priority')} as label from labels",
    "classify_priority_rank": f"select item, {case('rank')} as label from labels",
    "classify_risk_category": f"""
        select item, {case('category')} as label
        from labels""",
    "classify_recommendation_group": f"""
        select item, {case('group')} as label
        from labels""",
    "classify_performance_tier": f"select item, {case('tier')} as label from labels",
    "classify_leverage_risk": "select symbol as item, risk_assessment as label from article_latest",
    "classify_growth_and_leverage_action": """
        select symbol as item, action_recommendation as label from article_latest""",
    "classify_growth_recommendation": f"""
        select ticker_region as item,
               {case('growth')} as label
        from profile""",
}


# Queries that open with a comma add common table expressions of their own.
ORACLE: dict[str, str] = {name: f"{PRELUDE}\n{body.strip()}" for name, body in QUERIES.items()}
