"""The stop analyses end to end, over line items recast as a raw stop table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinwork.operators.approximate import approximate_neighbours
from veinwork.operators.sampling import SAMPLE_ROWS
from veinwork.plans import stop_analysis as S
from veinwork.plans.registry import query
from veinwork.sources.readers import table
from veinwork.sources.schema import coerce
from veinwork.sources.stops import STOP_FIELDS

STOP_KEYS = ("SeqID", "Location", "Geolocation")
STOP_ORDER = ("Location", "Geolocation")

# Raw text columns of the stop table as expressions over a line item; valid in both engines.
_WORDS = {
    "SeqID": "concat(l_orderkey, '-', l_linenumber)",
    "Location": "concat(l_partkey, ' ', l_suppkey)",
    "Agency": "'Police'",
    "SubAgency": "concat('District ', l_suppkey % 9)",
    "Violation Type": "case l_returnflag when 'A' then 'Warning' when 'R' then 'Citation' else 'ESERO' end",
    "VehicleType": "concat('Type ', l_linenumber)",
    "Gender": "case l_linestatus when 'F' then 'F' else 'M' end",
    "Race": "concat('Group ', l_partkey % 5)",
    "Description": "concat('Offence ', l_partkey % 211, ' of part ', l_suppkey % 83)",
    "Search Disposition": "case when l_partkey % 17 = 0 then concat('Found ', l_suppkey % 6) end",
    "Search Outcome": "case when l_partkey % 17 = 0 then concat('Outcome ', l_suppkey % 4) end",
    "Search Reason": "case when l_partkey % 17 = 0 then concat('Reason ', l_suppkey % 9) end",
    "Search Reason For Stop": "case when l_partkey % 17 = 0 then concat('21-', l_partkey % 800) end",
    "Search Type": "case when l_partkey % 17 = 0 then concat('Type ', l_suppkey % 5) end",
    "Search Arrest Reason": "case when l_partkey % 34 = 0 then concat('Arrest ', l_suppkey % 7) end",
    "State": "case l_suppkey % 10 when 0 then 'VA' when 1 then 'DC' else 'MD' end",
    "Make": "case when l_partkey % 23 <> 0 then concat('Make ', l_suppkey % 60) end",
    "Model": "case when l_partkey % 19 <> 0 then concat('Model ', l_partkey % 300) end",
    "Color": "concat('Color ', l_suppkey % 12)",
    "Charge": "concat('13-', l_partkey % 400, '.', l_suppkey % 3)",
    "Article": "case when l_linenumber <> 4 then 'Transportation Article' end",
    "Driver City": "concat('City ', l_suppkey % 97)",
    "Driver State": "case l_suppkey % 7 when 0 then 'PA' else 'MD' end",
    "DL State": "case l_suppkey % 8 when 0 then 'WV' else 'MD' end",
    "Arrest Type": "concat('Kind ', l_linenumber % 3)",
}
_FLAGS = {
    "Accident": "l_discount >= 0.09",
    "Personal Injury": "l_discount >= 0.10 and l_partkey % 3 = 0",
    "Property Damage": "l_discount >= 0.08 and l_partkey % 4 = 0",
    "Fatal": "l_discount >= 0.10 and l_partkey % 41 = 0",
    "Alcohol": "l_tax >= 0.07 and l_suppkey % 3 = 0",
    "Work Zone": "l_partkey % 29 = 0",
    "Belts": "l_suppkey % 7 = 0",
    "Commercial License": "l_suppkey % 11 = 0",
    "Commercial Vehicle": "l_suppkey % 11 = 0 and l_partkey % 2 = 0",
    "HAZMAT": "l_suppkey % 11 = 0 and l_partkey % 31 = 0",
    "Search Conducted": "l_partkey % 17 = 0",
    "Contributed To Accident": "l_discount >= 0.09 and l_partkey % 5 = 0",
}
_NUMBERS = {
    "Latitude": "cast(38.9 + l_quantity / 100 as string)",
    "Longitude": "case when l_partkey % 101 = 0 then '-200.5' else cast(l_extendedprice / 200000 - 77.3 as string) end",
    "Year": "case when l_partkey % 53 = 0 then '1850' else cast(1990 + l_suppkey % 36 as string) end",
}


def raw_stops(spark, folder: str) -> DataFrame:
    """A stop table as a CSV would bring it, all text."""
    lines = table(spark, folder, "lineitem")
    seconds = F.expr("(l_partkey * 37 + l_suppkey * 61) % 86400")
    clock = F.concat_ws(
        ":", *[F.lpad(part.cast("long").cast("string"), 2, "0")
               for part in (F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60)])
    return lines.select(
        *[F.expr(e).alias(n) for n, e in {**_WORDS, **_NUMBERS}.items()],
        *[F.expr(f"case when {e} then 'Yes' else 'No' end").alias(n) for n, e in _FLAGS.items()],
        F.when(F.expr("l_partkey % 97 = 0"), "25:00:00").otherwise(clock).alias("Time Of Stop"),
        F.date_format(F.add_months("l_shipdate", 240), "MM/dd/yyyy").alias("Date Of Stop"),
        F.concat_ws(" ", *[F.col(c).cast("string") for c in
                           ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate")]
                    ).alias("Geolocation"),
    )


def stops(spark, folder: str) -> DataFrame:
    return coerce(raw_stops(spark, folder), STOP_FIELDS)


@query(f"""
with s as (select concat(l_orderkey, '-', l_linenumber) as id, l_suppkey % 9 as district, l_discount >= 0.09 as accident,
  l_discount >= 0.09 and l_partkey % 5 = 0 as contributed,
  case when l_partkey % 53 = 0 then 1850 else 1990 + l_suppkey % 36 end as year from lineitem)
select 'rows' as metric, count(*)::double as value from s
union all select 'ids', count(distinct id)::double from s
union all select 'accident_pct', round(avg(accident::int) * 100.0::double, 6) from s
union all select 'contributed_pct', round(avg(contributed::int) * 100.0::double, 6) from s
union all select 'median_year', quantile_cont(year, 0.5)::double from s
union all select 'n_rows', count(*)::double from s
union all select 'n_columns', {len(_WORDS) + len(_FLAGS) + len(_NUMBERS) + 3}::double
union all select 'sub_agencies', count(distinct district)::double from s
union all select 'missing', sum({' + '.join(f'(({e}) is null)::int' for e in _WORDS.values())})::double from lineitem
""")
def stop_profile(spark, folder):
    typed = stops(spark, folder)
    report = S.profile(typed)
    duplicates = report["duplicates"].select(
        F.inline(F.array(
            F.struct(F.lit("rows").alias("metric"), F.col("n_rows").cast("double").alias("value")),
            F.struct(F.lit("ids").alias("metric"), F.col("n_keys").cast("double").alias("value")))))
    names = F.create_map(F.lit("Accident"), F.lit("accident_pct"),
                         F.lit("Contributed To Accident"), F.lit("contributed_pct"))
    named = F.col("column").isin("Accident", "Contributed To Accident")
    flags = report["flags"].filter("value").filter(named).select(names[F.col("column")].alias("metric"), F.col("pct").alias("value"))
    year = report["numbers"].filter(F.col("column") == "Year").select(
        F.lit("median_year").alias("metric"), F.col("median").alias("value"))
    shape = report["shape"].select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in ("n_rows", "n_columns")])))
    kinds = report["categories"].filter(F.col("column") == "SubAgency").groupBy().agg(
        F.max("n_distinct").cast("double").alias("value")).select(F.lit("sub_agencies").alias("metric"), "value")
    gaps = report["missing"].agg(F.coalesce(F.sum("missing"), F.lit(0)).cast("double").alias("value")).select(
        F.lit("missing").alias("metric"), "value")
    return duplicates.unionByName(flags).unionByName(year).unionByName(shape).unionByName(kinds).unionByName(gaps)


@query()
def stop_classification(spark, folder):
    result = S.classify(stops(spark, folder), STOP_KEYS)
    scores = result["accuracy"].select(F.col("split").alias("metric"), F.col("accuracy").alias("value"))
    folds = result["folds"].select(F.concat(F.lit("fold "), "fold").alias("metric"), F.col("accuracy").alias("value"))
    return scores.unionByName(folds)


@query()
def stop_clustering(spark, folder):
    result = S.cluster(stops(spark, folder), STOP_KEYS)
    return result["profile"]


_screenings: dict[tuple[str, str], dict[str, DataFrame]] = {}


_preparations: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _preparation(spark, folder) -> dict[str, DataFrame]:
    """The prepared tables of a folder, stored once for all queries of an application that read them."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _preparations:
        # The charge names the line item, so that only equal line items are duplicates.
        typed = stops(spark, folder).withColumn("Charge", F.concat_ws(" ", "SeqID", "Geolocation"))
        _preparations[key] = S.prepare(typed)
    return _preparations[key]


def _screening(spark, folder) -> dict[str, DataFrame]:
    """The screening of a folder, stored once for all queries of an application that read it."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _screenings:
        _screenings[key] = S.screen_outliers(stops(spark, folder), STOP_ORDER)
    return _screenings[key]


@query()
def outlier_screening(spark, folder):
    return _screening(spark, folder)["flags"]


@query()
def outlier_screening_approximate(spark, folder):
    """The screening with approximate neighbours, in work that is linear in the rows."""
    return S.screen_outliers(stops(spark, folder), STOP_ORDER, neighbours=approximate_neighbours)["flags"]


@query()
def outlier_screening_sample(spark, folder):
    """The screening with neighbours from a sample of SAMPLE_ROWS rows."""
    return S.screen_outliers(stops(spark, folder), STOP_ORDER, fit_rows=SAMPLE_ROWS)["flags"]


_VALID_SQL = """
keyed as (select *, row_number() over (partition by l_orderkey, l_linenumber
    order by concat(l_partkey, ' ', l_suppkey), concat_ws(' ', l_quantity, l_extendedprice, l_discount, l_tax,
      l_returnflag, l_shipdate)) as r from lineitem),
valid as (select * from keyed where r = 1 and l_partkey % 101 <> 0 and l_partkey % 53 <> 0
  and l_partkey % 97 <> 0 and l_shipdate + interval 240 month between timestamp '2015-01-01' and timestamp '2025-12-31')
"""
_CODED = {
    "vehicle": _WORDS["VehicleType"], "district": _WORDS["SubAgency"], "gender": _WORDS["Gender"], "race": _WORDS["Race"],
    "band": "case when hour < 6 then 'Night' when hour < 12 then 'Morning' when hour < 18 then 'Afternoon' else 'Evening' end",
}
_MEASURES = {
    "lat": "38.9 + l_quantity / 100", "lon": "l_extendedprice / 200000 - 77.3", "hour": "hour", "month": "month(day)",
    "dow": "isodow(day) - 1", "weekend": "(isodow(day) >= 6)::int", "age": "greatest(0, least(50, 2025 - (1990 + l_suppkey % 36)))",
    **{f"flag{i}": f"({_FLAGS[n]})::int" for i, n in enumerate(S.OUTLIER_FLAGS)},
    **{c: f"dense_rank() over (order by {c}_word) - 1" for c in _CODED},
}
THOUSAND = 1_000


@query(f"""
with {_VALID_SQL},
timed as (select *, l_shipdate + interval 240 month as day, ((l_partkey * 37 + l_suppkey * 61) % 86400) // 3600 as hour from valid),
worded as (select *, concat(l_orderkey, '-', l_linenumber) as id, {_FLAGS['Accident']} as accident,
  {', '.join(f'{e} as {c}_word' for c, e in _CODED.items())} from timed),
measured as (select id, accident, {', '.join(f'({e})::double as m_{c}' for c, e in _MEASURES.items())} from worded),
scaled as (select id, accident, count(*) over () as total, count(*) over (partition by accident) as stratum,
  row_number() over (partition by accident order by md5(id || '|2025'), id) as place,
  [{', '.join(f'coalesce((m_{c} - avg(m_{c}) over ()) / nullif(stddev_pop(m_{c}) over (), 0), 0)' for c in _MEASURES)}] as x
  from measured),
drawn as (select id, x from scaled where place <= round_even(stratum * least(1, {THOUSAND}::double / total), 0)),
gaps as (select a.id, b.id as neighbor, sqrt(list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) as distance
  from drawn a join drawn b on a.id <> b.id),
edges as (select * from gaps qualify row_number() over (partition by id order by distance, neighbor) <= 20),
kd as (select id, max(distance) as k_distance, avg(distance) as score from edges group by 1),
density as (select e.id, 1.0::double / (avg(greatest(distance, k_distance)) + 1e-10) as lrd
  from edges e join kd on kd.id = e.neighbor group by 1),
lof as (select e.id, avg(n.lrd) / any_value(o.lrd) as lof
  from edges e join density n on n.id = e.neighbor join density o on o.id = e.id group by 1),
flags as (select id, score, lof, score > (select quantile_cont(score, 0.99) from kd) as a,
  lof > (select quantile_cont(lof, 0.99) from lof) as b from kd join lof using (id))
select id as "SeqID", round(score, 6) as distance_score, a as distance_outlier, round(-lof, 6) as lof_score, b as lof_outlier,
  a and b as common_outlier from flags
""")
def outlier_screening_thousand(spark, folder):
    """The screening of a stratified sample of THOUSAND rows by itself."""
    flags = S.screen_outliers(stops(spark, folder), STOP_ORDER, only_rows=THOUSAND)["flags"]
    return flags.withColumns({c: F.round(c, 6) for c in ("distance_score", "lof_score")})


@query(f"""
with {_VALID_SQL}
select count(*) as n_rows, count(distinct (l_orderkey, l_linenumber)) as n_stops from valid
""")
def outlier_screening_rows(spark, folder):
    """Every valid stop has its flags, once."""
    flags = _screening(spark, folder)["flags"]
    return flags.agg(F.count("common_outlier").alias("n_rows"), F.count_distinct("SeqID").alias("n_stops"))


@query("select count(*) as n_rows from lineitem where l_quantity is not null and l_extendedprice is not null")
def stop_clustering_rows(spark, folder):
    """Every stop that has coordinates is in a cluster."""
    return S.cluster(stops(spark, folder), STOP_KEYS)["sizes"].agg(F.sum("n").alias("n_rows"))


@query()
def outlier_screening_groups(spark, folder):
    return _screening(spark, folder)["comparison"]


@query("""
with c as (select l_discount >= 0.09 as accident, count(distinct (l_orderkey, l_linenumber, l_partkey, l_suppkey,
    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)) as n from lineitem group by 1),
q as (select *, round_even(n * 0.2::double, 0) as test from c),
p as (select *, round_even((n - test) * 0.25::double, 0) as validation from q)
select accident as "Accident", 'test' as split, test::bigint as n from p
union all select accident, 'validation', validation::bigint from p
union all select accident, 'train', (n - test - validation)::bigint from p
""")
def stop_preparation(spark, folder):
    return _preparation(spark, folder)["distribution"]


_DISTINCT_SQL = """
items as (select distinct l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, l_shipdate from lineitem)
"""


@query(f"""
with gaps as (select count(*) as n, count(*) filter (({_WORDS['Make']}) is null) as make,
  count(*) filter (({_WORDS['Search Outcome']}) is null) as outcome from lineitem)
select 'Make' as "column", 'filled with ''Unknown''' as action, make as missing, round(make * 100.0::double / n, 6) as missing_pct from gaps
union all select 'Search Outcome', 'dropped', outcome, round(outcome * 100.0::double / n, 6) from gaps
""")
def stop_imputation(spark, folder):
    return _preparation(spark, folder)["imputation"]


@query(f"""
with {_DISTINCT_SQL},
timed as (select *, l_shipdate + interval 240 month as day, case when l_partkey % 53 = 0 then 50 else greatest(0, least(50, 35 - l_suppkey % 36)) end as age,
  case when l_partkey % 97 = 0 then 25 else ((l_partkey * 37 + l_suppkey * 61) % 86400) // 3600 end as hour from items)
select case when month(day) in (12, 1, 2) then 'Winter' when month(day) <= 5 then 'Spring' when month(day) <= 8 then 'Summer' else 'Fall' end as "Season",
  dayname(day) as "WeekdayName", case when age <= 3 then 'New' when age <= 7 then 'Recent' when age <= 15 then 'Middle' else 'Old' end as "VehicleAgeBand",
  case when hour >= 5 and hour < 12 then 'Morning' when hour >= 12 and hour < 17 then 'Afternoon'
    when hour >= 17 and hour < 22 then 'Evening' else 'Night' end as "TimeOfDay", count(*) as n, sum(hour)::bigint as hours
from timed group by all
""")
def stop_constructed(spark, folder):
    built = _preparation(spark, folder)["constructed"]
    return built.groupBy("Season", "WeekdayName", "VehicleAgeBand", "TimeOfDay").agg(F.count(F.lit(1)).alias("n"), F.sum("Hour").alias("hours"))


_SUMMED = ("Make", "Color", "Race", "Gender", "State", "Driver State", "VehicleType", "Violation Type")


@query(f"with {_DISTINCT_SQL} " + " union all ".join(
    f"""select '{c}' as "column", count(*) as n, sum(code)::bigint as codes from (select dense_rank() over (order by word) - 1 as code
    from (select coalesce({_WORDS[c]}, 'Unknown') as word from items))""" for c in _SUMMED))
def stop_encoded(spark, folder):
    """Rows and the sum of the codes of encoded columns, whose values all occur among the training rows."""
    coded = _preparation(spark, folder)["encoded"]
    one = coded.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"`{c}_encoded`").alias(f"s{i}") for i, c in enumerate(_SUMMED)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("n"), F.col(f"s{i}").alias("codes")) for i, c in enumerate(_SUMMED)])))


@query("""
with c as (select l_discount >= 0.09 as accident, count(distinct (l_orderkey, l_linenumber, l_partkey, l_suppkey,
    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)) as n from lineitem group by 1),
q as (select *, round_even(n * 0.2::double, 0) as test from c),
p as (select *, round_even((n - test) * 0.25::double, 0) as validation from q)
select 'test' as split, 'Charge' as "column", sum(test)::bigint as replaced from p
union all select 'validation', 'Charge', sum(validation)::bigint from p
""")
def stop_unseen(spark, folder):
    """Every charge names its item, so none of the test and validation rows was seen in training."""
    return _preparation(spark, folder)["replaced"].filter("replaced > 0 and column = 'Charge'")


@query()
def stop_centroid_outliers(spark, folder):
    return S.centroid_screen(stops(spark, folder), STOP_ORDER)["marked"]
