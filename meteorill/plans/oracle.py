"""The same queries as SQL for duckdb, over the same tables."""

from meteorill.plans.fixtures import BATCHES, FLOOR, INVENTORY_YEAR, MOVE_DAY, SERIES_YEARS, SPATIAL_YEAR, TOP_VARIABLES

_STATION_ID = """case s_nationkey % 5 when 0 then 'CH' when 1 then 'GM' when 2 then 'GR'
    when 3 then 'BR' else 'IS' end || lpad(cast(s_suppkey as varchar), 9, '0')"""

# Each view may use those before it.
VIEWS = {
    "obs": f"""
        select {_STATION_ID} as StationId,
          cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as int) as Date,
          case when l_linenumber <= 2 then 'TMAX' when l_linenumber <= 4 then 'TMIN'
               when l_linenumber <= 6 then 'PRCP' else 'SNWD' end as Variable,
          cast(l_quantity * 10 as int) as Value,
          cast(null as varchar) as M_Flag,
          case when l_discount > 0.095 then 'X' end as Q_Flag,
          cast(null as varchar) as S_Flag,
          '0700' as ObsTime,
          (l_orderkey * 10 + l_linenumber) * 10000 + cast(l_quantity * 10 as int) as seq
        from lineitem join supplier on l_suppkey = s_suppkey""",
    "all_stations": f"""
        select {_STATION_ID} as StationIdA,
          cast((s_suppkey * 37) % 1800 as double) / 10 - 90 as LATITUDE,
          cast((s_suppkey * 53) % 3600 as double) / 10 - 180 as LONGITUDE,
          cast((s_suppkey * 7) % 500 as double) as ELEVATION
        from supplier""",
    "stations": "select * from all_stations where cast(substr(StationIdA, 3) as bigint) % 10 <> 9",
    "inventory": """
        select case c_nationkey % 6 when 0 then 'CH' when 1 then 'GM' when 2 then 'GR' when 3 then 'BR'
            when 4 then 'IS' else 'ZZ' end || lpad(cast(c_custkey as varchar), 9, '0') as ID,
          'P' || substr(o_orderpriority, 1, 1) || '_' || o_orderstatus as VARIABLE,
          cast(min(year(o_orderdate)) as int) as FIRSTYEAR, cast(max(year(o_orderdate)) as int) as LASTYEAR
        from orders join customer on o_custkey = c_custkey group by all""",
    "recent": f"""
        select * from inventory where FIRSTYEAR >= {INVENTORY_YEAR} or LASTYEAR > {INVENTORY_YEAR}""",
    "cleaned": f"""
        select StationId, Date, Variable, Value, seq, cast(Date % 4 as bigint) as batch_id
        from obs
        where Date >= {FLOOR} and Q_Flag is null and Variable in ('TMAX', 'TMIN', 'PRCP')""",
    "daily": """
        select StationId, Date, batch_id,
          min_by(Value, seq) filter (Variable = 'TMAX') as TMAX,
          min_by(Value, seq) filter (Variable = 'TMIN') as TMIN,
          min_by(Value, seq) filter (Variable = 'PRCP') as PRCP
        from cleaned group by StationId, Date, batch_id""",
    "dated": """
        select *, cast((Date // 100) % 100 as int) as Month, cast(Date // 10000 as int) as Year
        from daily""",
}


def _sums(divisor: str = "count({})") -> str:
    return ", ".join(
        [f"cast(sum({v}) as bigint) as Sum{v.title()}" for v in ("TMAX", "TMIN", "PRCP")]
        + [f"{divisor.format(v)} as count{v.title()}" for v in ("TMAX", "TMIN", "PRCP")]
    )


VIEWS |= {
    "monthly": f"""
        select StationId, Month, Year, {_sums()} from dated group by StationId, Month, Year""",
    "monthly_distinct": f"""
        select StationId, Month, Year, {_sums("count(distinct {})")}
        from dated group by StationId, Month, Year""",
    "batches": f"""
        select batch_id, StationId, Month, Year, {_sums()}
        from dated group by batch_id, StationId, Month, Year""",
}


def _weather(monthly: str) -> str:
    return f"""
        select StationId, Month, Year,
          cast(SumTmax as double) / countTmax as AvgTmax,
          cast(SumTmin as double) / countTmin as AvgTmin,
          cast(SumPrcp as double) / countPrcp as AvgPrcp,
          substr(StationId, 1, 2) as FIPS_code, LATITUDE, LONGITUDE, ELEVATION
        from {monthly} left join stations on StationIdA = StationId
        where countTmax > 0 and countTmin > 0 and countPrcp > 0"""


VIEWS |= {
    "weather": _weather("monthly"),
    "weather_distinct": _weather("monthly_distinct"),
    "top": """
        select FIPS_code, StationId, rank from (
          select FIPS_code, StationId,
            cast(row_number() over (partition by FIPS_code order by StationId) as int) as rank
          from (select distinct FIPS_code, StationId from weather))
        where rank <= 3""",
    "counts": """
        select substr(ID, 1, 2) as FIPS, VARIABLE, count(*) as n from recent
        where substr(ID, 1, 2) in ('CH', 'GM', 'GR', 'BR', 'IS') group by all""",
    "ranked": f"""
        select * from (
          select FIPS, VARIABLE, n,
            cast(row_number() over (partition by FIPS order by n desc, VARIABLE) as int) as rank
          from counts)
        where rank <= {TOP_VARIABLES}""",
    "countries": """
        select * from (values ('CH', 'China'), ('GM', 'Germany'), ('GR', 'Greece'),
          ('BR', 'Brazil'), ('IS', 'Israel')) as t(FIPS, country)""",
    "labelled": """
        select *, cast(case
          when FIPS_code = 'CH' then
            case when Month in (3, 4) then 1 when Month in (5, 6, 7) then 2
                 when Month in (8, 9, 10) then 3 else 4 end
          when FIPS_code = 'BR' then
            case when Month >= 10 then 1 when Month <= 3 then 2 when Month <= 6 then 3 else 4 end
          else
            case when Month in (3, 4, 5) then 1 when Month in (6, 7, 8) then 2
                 when Month in (9, 10, 11) then 3 else 4 end
          end as int) as Season,
          case when ('0x' || substr(md5(StationId || '|' || Year || '|' || Month), 1, 4))::int % 10 < 7
               then 'train' else 'test' end as split
        from weather""",
    # The elastic net on one standardised feature, regParam 0.5 and elasticNetParam 0.8.
    "elastic": """
        select slope, my - slope * mx as intercept from (
          select mx, my, sign(r) * greatest(abs(r) - 0.8 * e, 0) / (1 + 0.2 * e) * sy / sx as slope from (
            select avg(AvgTmax) as mx, avg(AvgPrcp) as my, corr(AvgPrcp, AvgTmax) as r,
              stddev_samp(AvgTmax) as sx, stddev_samp(AvgPrcp) as sy, 0.5 / stddev_samp(AvgPrcp) as e
            from labelled where split = 'train'))""",
    "codes": """
        select FIPS_code, cast(row_number() over (order by n desc, FIPS_code) - 1 as double) as FIPS_index
        from (select FIPS_code, count(*) as n from weather group by FIPS_code)""",
    "complete": """
        select * from weather join codes using (FIPS_code)
        where LATITUDE is not null and LONGITUDE is not null and ELEVATION is not null""",
}

_SCALARS = {"Month": "Month - 6.5e0", "Year": "Year - 2000e0", "AvgTmin": "AvgTmin", "AvgTmax": "AvgTmax", "LONGITUDE": "LONGITUDE",
            "LATITUDE": "LATITUDE", "ELEVATION": "ELEVATION", "AvgPrcp": "AvgPrcp"}
_FOREST = ("AvgPrcp", "AvgTmin", "AvgTmax", "Year", "LATITUDE", "LONGITUDE", "ELEVATION")
_KNOWN = "LATITUDE is not null and LONGITUDE is not null and ELEVATION is not null"
_FOLD = "(('0x' || substr(md5(StationId || '|' || Year || '|' || Month), 1, 4))::int % 3)"
_SEASONS = range(1, 5)


def _model_sums() -> str:
    columns = list(_SCALARS)
    sums = [f"round(sum(case when {_KNOWN} then {_SCALARS[c]} end), 3) as s_{c}" for c in columns]
    pairs = [(a, b) for k, a in enumerate(columns) for b in columns[k:]]
    sums += [f"round(sum(case when {_KNOWN} then ({_SCALARS[a]}) * ({_SCALARS[b]}) end), 3) as p_{a}_{b}" for a, b in pairs]
    return f"""select FIPS_code, cast({_FOLD} as int) as fold, split, count(*) as n_rows, count(*) filter ({_KNOWN}) as n, {", ".join(sums)}
        from labelled group by all"""


def _gini(sums: list[str], total: str) -> str:
    squares = " + ".join(f"{c}::double * {c}" for c in sums)
    return f"({total} - ({squares}) / ({total}))"


_LEFT, _ALL = [f"l_n_{c}" for c in _SEASONS], [f"t_n_{c}" for c in _SEASONS]
_RIGHT = [f"({t} - {x})" for t, x in zip(_ALL, _LEFT, strict=True)]
VIEWS |= {
    "feature_values": " union all ".join(
        f"select FIPS_code, '{c}' as feature, {k} as place, cast({c} as double) as value, Season from labelled where split = 'train' and {_KNOWN}"
        for k, c in enumerate(_FOREST)
    ),
    "value_classes": f"""
        select FIPS_code, feature, place, value, {", ".join(f"count(*) filter (Season = {c}) as n_{c}" for c in _SEASONS)}
        from feature_values group by all""",
    "feature_splits": f"""
        select FIPS_code, feature, place, value, lead(value) over byvalue as next,
          {", ".join(f"cast(sum(n_{c}) over byvalue as bigint) as l_n_{c}" for c in _SEASONS)},
          {", ".join(f"cast(sum(n_{c}) over (partition by FIPS_code, feature) as bigint) as t_n_{c}" for c in _SEASONS)}
        from value_classes window byvalue as (partition by FIPS_code, feature order by value)""",
    "split_gains": f"""
        select FIPS_code, feature, place, (value + next) / 2 as threshold, {" + ".join(_LEFT)} as n_left,
          {" + ".join(_RIGHT)} as n_right,
          round(({_gini(_ALL, "(" + " + ".join(_ALL) + ")")} - {_gini(_LEFT, "(" + " + ".join(_LEFT) + ")")}
            - {_gini(_RIGHT, "(" + " + ".join(_RIGHT) + ")")}) / ({" + ".join(_ALL)}), 12) as gain
        from feature_splits where next is not null""",
    # The elastic net on one standardised feature, in every fold's training rows.
    "fold_moments": f"""
        select fold, avg(AvgTmax) as mx, avg(AvgPrcp) as my, corr(AvgPrcp, AvgTmax) as r,
          stddev_pop(AvgTmax) as sx, stddev_pop(AvgPrcp) as sy
        from (select * from range(3) as f(fold)) join (select *, {_FOLD} as own from labelled where {_KNOWN}) on own <> fold
        group by fold""",
    "fold_slopes": """
        select fold, regParam, elasticNetParam, mx, my,
          sign(r) * greatest(abs(r) - regParam / sy * elasticNetParam, 0)
            / (1 + regParam / sy * (1 - elasticNetParam)) * sy / sx as slope
        from fold_moments, (values (0.1e0), (0.5e0), (1e0)) as a(regParam), (values (0e0), (0.5e0), (0.8e0)) as b(elasticNetParam)""",
}

_WEATHER_COLUMNS = (
    "StationId, Month, Year, AvgTmax, AvgTmin, AvgPrcp, FIPS_code, LATITUDE, LONGITUDE, ELEVATION"
)
_ENRICHED = "substr(StationId, 1, 2) as FIPS_code, LATITUDE, LONGITUDE, ELEVATION"
_TEMPORAL = """select distinct StationId, Year as Y, AvgPrcp as PRCP, AvgTmax as T, Month as M
    from weather where Month in (1, 8)
      and StationId in (select StationId from top where FIPS_code = 'GM')"""
_SPATIOTEMPORAL = f"""select distinct StationId, Month as M, AvgPrcp as PRCP, Year as Y
    from weather where Year in {SERIES_YEARS}
      and StationId in (select StationId from top where rank = 1 and FIPS_code in ('GM', 'GR', 'CH'))"""
_RMSE = "sqrt(avg((AvgTmax - AvgPrcp) * (AvgTmax - AvgPrcp)))"
_HIT = "avg(case when 1 + (Month - 1) // 3 = Season then 1e0 else 0e0 end)"
_ONE_HOT = [f"case when FIPS_index = {i} then 1e0 else 0e0 end" for i in range(4)]


def _named(expressions: list[str]) -> str:
    return ", ".join(f"cast({e} as double) as f{i}" for i, e in enumerate(expressions))


SELECTS = {
    # The text lines carry four decimals.
    "station_fixed_width": """
        select StationIdA, round(LATITUDE, 4) as LATITUDE, round(LONGITUDE, 4) as LONGITUDE, ELEVATION
        from all_stations""",
    "inventory_scan": """
        select ID,
          round(cast((n * 37) % 1800 as double) / 10 - 90, 4) as LATITUDE,
          round(cast((n * 53) % 3600 as double) / 10 - 180, 4) as LONGITUDE,
          VARIABLE, FIRSTYEAR, LASTYEAR
        from (select *, cast(substr(ID, 3) as bigint) as n from inventory)""",
    "partials_table": f"""
        select StationId, Month, Year, SumTmax, SumTmin, SumPrcp, countTmax, countTmin, countPrcp,
          {_ENRICHED}, 'main' as stream, batch_id
        from batches left join stations on StationIdA = StationId""",
    "weather_table": f"select {_WEATHER_COLUMNS} from weather",
    "json_observations":
        "select StationId, Date, Variable, Value, M_Flag, Q_Flag, S_Flag, ObsTime from obs",
    "clean_observations": "select StationId, Date, Variable, Value from cleaned",
    "date_parts": """
        select Date, cast(Date // 10000 as int) as Year, cast((Date // 100) % 100 as int) as Month
        from obs""",
    "fips_code": "select StationId, substr(StationId, 1, 2) as FIPS_code from obs",
    "daily_pivot": "select StationId, Date, TMAX, TMIN, PRCP from daily",
    "pivot_missing_variable": """
        select StationId, Month, Year, SumTmax, cast(null as bigint) as SumTmin, SumPrcp,
          countTmax, cast(0 as bigint) as countTmin, countPrcp
        from monthly where countTmax > 0 or countPrcp > 0""",
    "monthly_partials": "select * from monthly",
    "partials_sample": "select * from monthly order by StationId, Year, Month limit 5",
    "monthly_partials_by_batch": "select * from batches",
    "merge_partials": "select * from monthly",
    "enrich_stations": f"""
        select monthly.*, {_ENRICHED}, 'main' as stream, cast(0 as bigint) as batch_id
        from monthly left join stations on StationIdA = StationId""",
    "exact_distinct_values": "select * from monthly_distinct",
    "approx_distinct_values": """
        select StationId, Month, Year, SumTmax, SumTmin, SumPrcp,
          1 as near_countTmax, 1 as near_countTmin, 1 as near_countPrcp
        from monthly""",
    "sketch_distinct_values": "select * from monthly_distinct",
    "bit_distinct_values": "select * from monthly_distinct",
    "weather_distinct_divisor": f"select {_WEATHER_COLUMNS} from weather_distinct",
    "weather_approx_divisor": f"select {_WEATHER_COLUMNS} from weather_distinct",
    "inventory_recent": "select * from recent",
    "stations_per_country": """
        select FIPS, country, count(distinct ID) as n_stations
        from countries left join recent on substr(ID, 1, 2) = FIPS group by FIPS, country""",
    "variable_counts": "select * from counts",
    "top_variables": "select * from ranked",
    "variable_share": """
        select FIPS, country, VARIABLE, n, pct,
          cast(cast(pct as decimal(4, 1)) as varchar) || '%' || chr(10) || '(' || n || ')' as label
        from (select *, round(n * 100 / sum(n) over (partition by FIPS), 1) as pct from ranked)
        join countries using (FIPS)""",
    "station_list": "select distinct StationId from weather",
    "month_list": "select distinct Month from weather",
    "variable_list": "select distinct VARIABLE from inventory",
    "top_stations_per_country": "select * from top",
    "q_temporal": _TEMPORAL,
    "q_spatial_param": f"""
        select distinct StationId, LONGITUDE, LATITUDE, AvgPrcp
        from weather where FIPS_code = 'GM' and Year = {SPATIAL_YEAR} and Month = 2""",
    "q_spatiotemporal": _SPATIOTEMPORAL,
    "temporal_series": f"""
        select StationId, M, Y, 'PRCP' as measure, PRCP as value from ({_TEMPORAL})
        union all
        select StationId, M, Y, 'T', T / 10 from ({_TEMPORAL})""",
    "spatial_slices": f"""
        select distinct FIPS_code, country, Month,
          case Month when 2 then 'February' else 'August' end as month_name,
          StationId, LONGITUDE, LATITUDE, AvgPrcp
        from weather join countries on FIPS = FIPS_code
        where FIPS_code in ('CH', 'BR', 'GM') and Month in (2, 8) and Year = {SPATIAL_YEAR}""",
    "spatial_pairs": f"""
        select distinct FIPS_code, Month, StationId, LONGITUDE, LATITUDE, AvgPrcp
        from weather where Year = {SPATIAL_YEAR} and
          (FIPS_code = 'CH' and Month = 2 or FIPS_code = 'BR' and Month = 8
           or FIPS_code = 'GM' and Month = 2)""",
    "spatiotemporal_series":
        f"select Y, StationId, M as x, PRCP as value from ({_SPATIOTEMPORAL})",
    "temp_prcp_corr": """
        select StationId, Month, count(*) as n_years,
          case when min(AvgTmax) < max(AvgTmax) and min(AvgPrcp) < max(AvgPrcp)
               then round(corr(AvgTmax, AvgPrcp), 6) end as corr
        from weather group by StationId, Month""",
    "stream_ingest": f"select {_WEATHER_COLUMNS} from weather",
    "stream_compacted": f"select {_WEATHER_COLUMNS} from weather",
    "stream_distinct_divisor": f"select {_WEATHER_COLUMNS} from weather_distinct",
    "stream_approx_divisor": f"select {_WEATHER_COLUMNS} from weather_distinct",
    "stream_monthly_state": f"select {_WEATHER_COLUMNS} from weather",
    "stream_moved_stations": f"""
        select monthly.* exclude (moved), substr(StationId, 1, 2) as FIPS_code,
          case when moved then -LATITUDE else LATITUDE end as LATITUDE, LONGITUDE,
          case when moved then ELEVATION + 10 else ELEVATION end as ELEVATION
        from (select *, cast(substr(StationId, 3) as bigint) % 3 = 0
                and Year * 10000 + Month * 100 + 31 >= {MOVE_DAY} as moved from monthly) as monthly
        left join stations on StationIdA = StationId""",
    "stream_progress": f"""
        select 'main' as stream, cast(Date % {BATCHES} as bigint) as batch_id, count(*) as input_rows
        from obs group by all""",
    "stream_daily_ingest": f"select {_WEATHER_COLUMNS} from weather",
    "rmse_overall": f"select round({_RMSE}, 6) as rmse from labelled",
    "rmse_by_country": f"""
        select split, FIPS_code, round({_RMSE}, 6) as rmse from labelled group by split, FIPS_code""",
    "rmse_train_test": f"""
        select FIPS_code, max(rmse) filter (split = 'train') as train,
          max(rmse) filter (split = 'test') as test
        from (select split, FIPS_code, round({_RMSE}, 6) as rmse from labelled group by all)
        group by FIPS_code""",
    "error_by_country": f"""
        select FIPS_code, round({_HIT}, 6) as accuracy, round(1 - {_HIT}, 6) as test_error
        from labelled group by FIPS_code""",
    "season_label": """
        select StationId, Year, Month, FIPS_code, Season,
          case Season when 1 then 'spring' when 2 then 'summer' when 3 then 'autumn' else 'winter' end
            as season_name
        from labelled""",
    "train_test_split": "select StationId, Year, Month, split from labelled",
    "incomplete_rows": """
        select FIPS_code, count(*) as n_rows, count(*) filter (LATITUDE is null) as n_incomplete
        from weather group by FIPS_code""",
    "fips_index": """
        select distinct FIPS_code, FIPS_index from complete""",
    "fips_onehot": f"select StationId, Year, Month, {_named(_ONE_HOT)} from complete",
    "feature_vector": f"""
        select StationId, Year, Month, {_named(
            ["Month", "Year", "AvgTmin", "AvgTmax", "LONGITUDE", "LATITUDE", "ELEVATION", *_ONE_HOT]
        )} from complete""",
    "feature_vector_location": f"""
        select StationId, Year, Month, {_named(
            ["AvgPrcp", "AvgTmin", "AvgTmax", "Year", "LATITUDE", "LONGITUDE", "ELEVATION"]
        )} from complete""",
    "lr_fit": """
        select round(regr_slope(AvgPrcp, AvgTmax), 6) as slope,
          round(regr_intercept(AvgPrcp, AvgTmax), 6) as intercept
        from weather""",
    "lr_elastic_one": "select round(slope, 4) as slope, round(intercept, 3) as intercept from elastic",
    "lr_elastic_one_rmse": """
        select split, round(sqrt(avg(pow(AvgPrcp - slope * AvgTmax - intercept, 2))), 3) as rmse
        from labelled cross join elastic group by split""",
    "model_sums": _model_sums(),
    "cv_single_feature": f"""
        select cast(s.fold as int) as fold, regParam::double as regParam, elasticNetParam::double as elasticNetParam,
          round(any_value(slope), 6) as slope,
          round(sqrt(avg(pow(AvgPrcp - my - slope * (AvgTmax - mx), 2))), 4) as rmse
        from fold_slopes s join (select *, {_FOLD} as own from labelled where {_KNOWN}) on own = s.fold
        group by all""",
    "rf_best_split": """
        select FIPS_code, feature, threshold, n_left, n_right, gain from split_gains
        qualify row_number() over (partition by FIPS_code order by gain desc, place, threshold) = 1""",
    "rf_feature_splits": "select * exclude (place) from feature_splits",
    "cv_refit_complete": """
        select StationId, Year, Month,
          case when LATITUDE is null or LONGITUDE is null or ELEVATION is null then 0 else 1 end as predicted
        from weather""",
    "rf_label_given_away": """
        select distinct FIPS_code, 1 as given_away from labelled
        where split = 'test' and LATITUDE is not null""",
    "rf_tested_rows": """
        select StationId, Year, Month, cast(Season as varchar) as label,
          case when LATITUDE is null or LONGITUDE is null or ELEVATION is null then 0 else 1 end as predicted
        from labelled where split = 'test'""",
}


def oracle_sql() -> dict[str, str]:
    views = ",\n".join(f"{name} as ({body})" for name, body in VIEWS.items())
    return {name: f"with {views}\n{select}" for name, select in SELECTS.items()}
