"""Independent DuckDB SQL for every registered relational query.

Each string runs against the driver's pre-registered views (region, nation,
customer, supplier, part, orders, lineitem, events, documents, embeddings,
pages, benchmark, labels, conversations). The derived inputs are inlined as
CTEs. Doubles whose value depends on summation order are rounded in both
dialects; counts are BIGINT and small integers INT in both.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Derived inputs (DuckDB dialect of tessera.sources.fixtures)
# ---------------------------------------------------------------------------

ACCESS_LOG = r"""access_log as (
select case when event_id%1000=7 then concat('garbage /Jan/2024 row ',event_id) when event_id%1000=11 then concat('stray - - [01/Feb/2024:00:00:01 -0400] "GET /x/stray.html" ',event_id) else concat('host',user_id,'.example.com - - [',strftime(ts,'%d/%b/%Y:%H:%M:%S'),' -0400] "GET /',event_type,'/f',(event_id*7)%97,case when event_id%5=0 then '.gif' else '.html' end,' HTTP/1.0" 200 ',cast(floor(value*100) as bigint)) end as value from events)"""

PARSED_LOG = r"""parsed as (
select value, try_strptime(nullif(regexp_extract(value, '\d{2}/Jan/2024:\d{2}:\d{2}:\d{2}', 0), ''), '%d/%b/%Y:%H:%M:%S') as ts
from access_log where contains(value, '/Jan/2024'))"""

RATINGS = """ratings as (
select o_custkey as userId,l_partkey as movieId,max((cast(l_quantity as int)%10+1)/2) as rating from lineitem join orders on l_orderkey=o_orderkey group by 1,2)"""

GENOME_SCORES = """genome_scores as (
select p_partkey as movieId,t as tagId,((p_partkey*31+t*17)%37)/36 as relevance from part cross join (select cast(unnest(range(1,41)) as int) t) where p_partkey%3<>0 and (p_partkey%7<>0 or t<=39))"""

GENOME_TAGS = """genome_tags as (
select t as tagId,concat('tag_',t) as tag from (select cast(unnest(range(1,41)) as int) t) where t%9<>0)"""

CLAIMS = """claims as (
select l_orderkey,l_linenumber,l_partkey,l_suppkey,cast(year(l_shipdate) as varchar) Calendar_Year,substr(o_orderpriority,1,1) OrdCat,cast(l_quantity as varchar) Var1,case when l_partkey%50=0 then null else cast(l_tax as varchar) end Var2,cast(l_discount as varchar) Var3,cast(l_linenumber as varchar) Var4,cast(p_size as varchar) Var5,cast(p_retailprice as varchar) Var6,cast(c_acctbal as varchar) Var7,cast(o_totalprice as varchar) Var8,p_type Cat1,c_mktsegment Cat2,o_orderstatus Cat3,l_linestatus Cat4,l_returnflag Cat5,cast(p_size%5 as varchar) Cat6,substr(p_type,1,3) Cat7,cast(c_nationkey as varchar) Cat8,cast(l_linenumber%3 as varchar) Cat9,cast(month(l_shipdate) as varchar) Cat10,cast(l_suppkey%7 as varchar) Cat11,case when l_suppkey%10=0 then null else l_returnflag end Cat12,cast(l_orderkey%4 as varchar) NVCat,p_brand Blind_Make,concat(p_type,'/',p_brand) Blind_Model,concat(p_name,'/',p_brand) Blind_Submodel,cast(year(o_orderdate) as varchar) Model_Year,case when l_orderkey%97=1 then null when l_orderkey%10=0 then cast(l_extendedprice as varchar) else '0' end Claim_Amount from lineitem join orders on l_orderkey=o_orderkey join part on l_partkey=p_partkey join customer on o_custkey=c_custkey)"""

PARTICLE_COLS = ", ".join(f"cast(embedding[{i + 1}] as double) as f{i + 1}" for i in range(28))
PARTICLES = f"""particles as (
select vec_id, cast(label>=5 as int) as label, cast(cast(embedding[1] as double)+cast(embedding[2] as double)>0 as int) as label_signal, {PARTICLE_COLS} from embeddings)"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def U(*keys: str, seed: int = 123) -> str:  # noqa: N802
    """A row's draw, stated apart from the library: the key's parts joined by
    '|', a colon and the seed; the first eight hex digits of the md5 of that
    text, read as a number and divided by 2**32."""
    text = f"concat(concat_ws('|', {', '.join(f'cast({k} as varchar)' for k in keys)}), ':', '{seed}')"
    return f"(cast(concat('0x', left(md5({text}), 8)) as ubigint) / power(2.0::double, 32))"


# ---------------------------------------------------------------------------
# Web logs
# ---------------------------------------------------------------------------

LOGS = {
    "log_parse": with_(ACCESS_LOG, PARSED_LOG) + """
select value, ts, cast(day(ts) as int) as day, cast(hour(ts) as int) as hour,
       cast(cast(floor(hour(ts)/4)+1 as int) as varchar) as hour_band
from parsed where ts is not null""",

    "log_filter_count": with_(ACCESS_LOG) + r"""
select count(*) as n_lines,
       count(*) filter (where contains(value,'/Jan/2024')) as n_month,
       count(*) filter (where contains(value,'/Jan/2024') and contains(value,'.html')) as n_html,
       count(*) filter (where contains(value,'/Jan/2024') and try_strptime(nullif(regexp_extract(value, '\d{2}/Jan/2024:\d{2}:\d{2}:\d{2}', 0), ''), '%d/%b/%Y:%H:%M:%S') is null) as n_unparsed
from access_log""",

    "log_daily_counts": with_(ACCESS_LOG, PARSED_LOG) + """
select cast(day(ts) as int) as day, count(*) as requests from parsed where ts is not null group by 1 order by 1""",

    "log_hour_bands": with_(ACCESS_LOG, PARSED_LOG) + """,
q as (select cast(cast(floor(hour(ts)/4)+1 as int) as varchar) as hour_band, day(ts) as day, ts from parsed where ts is not null),
d as (select cast(count(distinct day) as bigint) as observed_days, cast(max(day(last_day(ts))) as bigint) as calendar_days from q)
select hour_band,
       printf('%02d:00:00-%02d:59:59', (cast(hour_band as int)-1)*4, (cast(hour_band as int)-1)*4+3) as band_range,
       count(*) as requests, any_value(d.observed_days) as observed_days, any_value(d.calendar_days) as calendar_days,
       count(*)/any_value(d.observed_days) as avg_per_observed_day,
       count(*)/any_value(d.calendar_days) as avg_per_calendar_day
from q cross join d group by hour_band order by hour_band""",

    "log_top_files": with_(ACCESS_LOG) + """
select string_split(split_part(value, '.html', 1), '/')[-1] as file_name, count(*) as requests
from access_log where contains(value,'/Jan/2024') and contains(value,'.html')
group by 1 order by requests desc, file_name asc limit 20""",
}

LOGS["log_calendar"] = """
with moved as (
  select event_id, ts, cast(cast(ts as date) + to_months(cast(event_id % 5 as int)) as date) as date from events),
cells as (
  select date, cast(cast(floor(hour(ts)/4)+1 as int) as varchar) as hour_band, count(*) as n
  from moved where day(date) % 6 <> 0 and event_id % 500 <> 3 group by 1, 2),
span as (select date_trunc('month', min(date)) as first, last_day(max(date)) as last from cells),
spine as (
  select cast(d as date) as date, cast(b as varchar) as hour_band
  from (select unnest(generate_series(first, last, interval 1 day)) as d from span), range(1, 7) r(b)),
filled as (select s.date, s.hour_band, coalesce(c.n, 0) as requests from spine s left join cells c using (date, hour_band))
select cast(date as varchar) as date, hour_band, requests, cast(sum(requests) over m as bigint) as month_requests, round(avg(requests) over m, 9) as month_average
from filled window m as (partition by hour_band, date_trunc('month', date))"""

LOGS["log_report_file"] = with_(ACCESS_LOG, PARSED_LOG) + """,
top as (
  select string_split(split_part(value, '.html', 1), '/')[-1] as file_name, count(*) as requests
  from access_log where contains(value,'/Jan/2024') and contains(value,'.html') group by 1 order by requests desc, file_name limit 20),
daily as (select day(ts) as day, count(*) as requests from parsed where ts is not null group by 1)
select 'top_files' as file, cast(row_number() over (order by requests desc, file_name) as int) as line_no, concat(file_name, ',', requests) as line from top
union all select 'daily', cast(row_number() over (order by day) as int), concat(day, ',', requests) from daily
union all values ('top_files', 0, 'file_name,requests'), ('daily', 0, 'day,requests')"""

ORACLE: dict[str, str] = {}
ORACLE.update(LOGS)

# ---------------------------------------------------------------------------
# Reading: malformed lines, schemas
# ---------------------------------------------------------------------------

RATING_LINES = """lines as (
select *, (l_orderkey * 31 + l_linenumber * 7 + l_partkey) % 97 as m from lineitem)"""

_OUTCOME = "case m when 0 then 'short' when 1 then 'long' when 2 then 'type' when 3 then 'type' when 4 then 'quote' else 'good' end"
_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "array<float>": "FLOAT[]"}

INGEST_SQL = {
    "csv_outcomes": with_(RATING_LINES) + f"""
select {_OUTCOME} as outcome, count(*) as n from lines group by 1
union all select 'type of userId', count(*) from lines where m in (2, 4) having count(*) > 0
union all select 'type of rating', count(*) from lines where m = 3 having count(*) > 0
union all select 'type of timestamp', count(*) from lines where m = 3 having count(*) > 0
union all select 'lines', count(*) from lines""",

    "csv_good_rows": with_(RATING_LINES) + """
select case when m = 6 then -1 else l_orderkey end as userId, l_partkey as movieId, l_quantity as rating,
       case when m = 6 then -1 else cast(l_linenumber as bigint) end as timestamp from lines where m > 4""",

    "csv_bad_lines": with_(RATING_LINES) + f"""
select case m when 0 then concat(l_orderkey, ',', l_partkey)
  when 1 then concat(l_orderkey, ',', l_partkey, ',', l_quantity, ',', l_linenumber, ',extra')
  when 2 then concat('x', l_orderkey, ',', l_partkey, ',', l_quantity, ',', l_linenumber)
  when 3 then concat(l_orderkey, ',', l_partkey, ',abc,', l_linenumber, '.5')
  else concat('"', l_orderkey, ',', l_partkey, ',', l_quantity, ',', l_linenumber) end as line, {_OUTCOME} as outcome,
  case m when 0 then 'short' when 1 then 'long' when 2 then 'type:userId' when 3 then 'type:rating,type:timestamp' else 'quote,type:userId' end as reasons,
  case m when 0 then 2 when 1 then 5 else 4 end as n_fields
from lines where m < 5""",

    "table_schemas": "with c as (" + " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_null from {t}"
        for t, cols in {
            "region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"],
            "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
            "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
            "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
            "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
            "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                         "l_returnflag", "l_linestatus", "l_shipdate"],
            "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
            "documents": ["doc_id", "text", "lang", "source", "n_chars"], "embeddings": ["vec_id", "embedding", "label"],
            "pages": ["page_id", "url", "html"], "benchmark": ["item_id", "text"], "labels": ["doc_id", "quality", "toxic"],
            "conversations": ["conv_id", "turn", "role", "text"]}.items() for c in cols) + """)
select c.table_name, c.column_name, cast(i.ordinal_position as int) as position,
       case i.data_type """ + " ".join(f"when '{d}' then '{s}'" for s, d in _TYPES.items()) + """ else i.data_type end as data_type,
       c.n_null, c.n_rows
from c join information_schema.columns i on i.table_name = c.table_name and i.column_name = c.column_name""",
}
ORACLE.update(INGEST_SQL)

# ---------------------------------------------------------------------------
# Claims: profile, clean, dictionaries, encoding, stratified split
# ---------------------------------------------------------------------------

CLAIM_KEY_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
CLAIM_INTS = ["Calendar_Year", "OrdCat"]
CLAIM_NUMBERS = [f"Var{i}" for i in range(1, 9)]
CLAIM_STRINGS = [f"Cat{i}" for i in range(1, 13)] + ["NVCat"]
CLAIM_LARGE = ["Blind_Submodel", "Model_Year"]
CLAIM_TOPN = ["Blind_Make", "Blind_Model", "Blind_Submodel", "Model_Year"]


def _num(c: str) -> str:
    return f"coalesce(try_cast({c} as double), 0.0)"


CLEAN = f"""clean as (
select {CLAIM_KEY_SQL}, {", ".join(f"{_num(c)} as {c}" for c in CLAIM_INTS + CLAIM_NUMBERS)},
       {", ".join(f"coalesce({c},'ZZZ') as {c}" for c in CLAIM_STRINGS + CLAIM_LARGE)},
       {_num('Claim_Amount')} as Claim_Amount,
       cast({_num('Claim_Amount')} <> 0 as double) as y
from claims)"""


def _long(cols: list[str], src: str = "claims") -> str:
    return " union all ".join(
        f"select '{c}' as column_name, coalesce(cast({c} as varchar),'ZZZ') as value from {src}" for c in cols)


TOPN_SQL = f"""topn as (
select column_name, value, cast(rn as int) as id from (
  select column_name, value, row_number() over (partition by column_name order by n desc, value asc) as rn
  from (select column_name, value, count(*) as n from ({_long(CLAIM_TOPN)}) group by 1, 2)) where rn <= 20)"""

ORDINAL_SQL = f"""ordinal as (
select column_name, value, cast(dense_rank() over (partition by column_name order by value) as int) as id
from (select distinct column_name, value from ({_long(CLAIM_STRINGS)})))"""

# The learned Cat12 dictionary has 'ZZZ' here, so its replacement domain is
# not used; the forced pair is added.
OVERRIDE_SQL = """mapping as (
select column_name, value, id from (select * from topn union all select * from ordinal)
where not (column_name = 'Blind_Submodel' and value = 'AE.3.0')
union all select 'Blind_Submodel', 'AE.3.0', 0)"""


# Without missing values no 'ZZZ' is learned, so the replacement domain is used.
DOMAIN_SQL = "select 'Cat12' as column_name, value, cast(id as int) as id from (values " + ", ".join(
    f"('{v}', {i})" for v, i in {"ZZZ": 1, "F": 2, "E": 3, "B": 4, "D": 5, "C": 6, "A": 7}.items()) + ") d(value, id)"


def _enc(c: str) -> str:
    return (f"coalesce((select cast(m.id as double) from mapping m where m.column_name = '{c}' "
            f"and m.value = clean.{c}), 0.0) as {c}")


CLAIMS_SQL = {
    "csv_roundtrip": with_(CLAIMS) + "select * from claims",

    "label_cast": with_(PARTICLES) + "select vec_id, label, " + ", ".join(f"f{i}" for i in range(1, 29)) + " from particles",

    "null_profile": with_(CLAIMS) + " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as n_null from claims"
        for c in [*CLAIM_INTS, *CLAIM_NUMBERS, *CLAIM_STRINGS, *CLAIM_TOPN, "Claim_Amount"]),

    "dropped_columns": with_(CLAIMS) + "select 'Blind_Make' as column_name, count(Blind_Make) as n_values from claims union all select 'Blind_Model', count(Blind_Model) from claims",

    "claims_clean": with_(CLAIMS, CLEAN) + f"select {CLAIM_KEY_SQL}, {', '.join(CLAIM_INTS + CLAIM_NUMBERS + CLAIM_STRINGS + CLAIM_LARGE)}, Claim_Amount from clean",

    "claim_indicator": with_(CLAIMS, CLEAN) + f"select {CLAIM_KEY_SQL}, Claim_Amount, y from clean",

    "category_counts": with_(CLAIMS) + f"select column_name, value, count(*) as n from ({_long(CLAIM_STRINGS + CLAIM_TOPN)}) group by 1, 2",

    "distinct_categories": with_(CLAIMS) + f"select distinct column_name, value from ({_long(CLAIM_STRINGS)})",

    "encode_topn": with_(CLAIMS, TOPN_SQL) + "select * from topn",

    "encode_ordinal": with_(CLAIMS, ORDINAL_SQL) + "select * from ordinal",

    "encode_override": with_(CLAIMS, TOPN_SQL, ORDINAL_SQL, OVERRIDE_SQL) + "select * from mapping",

    "encode_domain": DOMAIN_SQL,

    "text_csv_roundtrip": "select doc_id, text, lang, source, n_chars from documents",

    "mapping_sizes": with_(CLAIMS, TOPN_SQL, ORDINAL_SQL, OVERRIDE_SQL) + "select column_name, count(*) as n_values from mapping group by 1",

    "encode_roundtrip": with_(CLAIMS, CLEAN, TOPN_SQL, ORDINAL_SQL, OVERRIDE_SQL) + f"""
select {CLAIM_KEY_SQL}, {", ".join(CLAIM_INTS + CLAIM_NUMBERS)}, {", ".join(_enc(c) for c in CLAIM_STRINGS + CLAIM_LARGE)},
       Claim_Amount, y from clean""",

    "stratified_split": with_(CLAIMS, CLEAN) + f"""
select {CLAIM_KEY_SQL}, y, case when {U('l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey', 'y')} < 0.7 then 'train' else 'test' end as split from clean""",
}
ORACLE.update(CLAIMS_SQL)

# ---------------------------------------------------------------------------
# Recommendation: folds, tag relevance, clusters (stand-in ids), fold matrix
# ---------------------------------------------------------------------------

FOLDS = f"""folds as (
select userId, movieId, rating, cast(floor({U('userId', 'movieId')}*3)+1 as int) as fold from ratings)"""
CLUSTERS = """clusters as (
select movieId, cast(least(movieId % 31, 24) as int) as prediction from (select distinct movieId from ratings))"""
BEST_TAG = """best as (
select movieId, relevance as max_relevance, tagId from (
  select movieId, tagId, relevance, row_number() over (partition by movieId order by relevance desc, tagId asc) as rn
  from genome_scores) where rn = 1)"""
TOP_CLUSTERS = """top_clusters as (
select prediction, count(*) as n_members from clusters group by 1 order by 2 desc, 1 asc limit 3)"""

_MATRIX_COLS = ", ".join(
    [f"round(max(case when fold = {f} then {m} end), 6) as {m}_{f}" for m in ("rmse", "mae") for f in (1, 2, 3)]
    + [f"round(avg({m}), 6) as mean_{m}, round(stddev_pop({m}), 6) as std_{m}" for m in ("rmse", "mae")])

RECOMMEND_SQL = {
    "kfold_train_test": with_(RATINGS, FOLDS) + "select * from folds",

    "fold_train_sets": with_(RATINGS, FOLDS) + """
select cast(k as int) as k, userId, movieId, case when fold = k then 'test' else 'train' end as part
from folds, range(1, 4) r(k)""",

    "ratings_csv": with_(RATINGS) + "select userId, movieId, rating from ratings",

    "tag_names_csv": with_(GENOME_TAGS) + "select tagId, tag from genome_tags",

    "best_tag_csv": with_(GENOME_SCORES, GENOME_TAGS, BEST_TAG) + """
select movieId, max_relevance, tag from best left join genome_tags using (tagId)""",

    "item_tag_counts": with_(GENOME_SCORES) + "select movieId, count(*) as n_tags from genome_scores group by 1",

    "complete_items": with_(GENOME_SCORES) + """
select count(*) as n_items, count(*) filter (where n = 40) as n_complete
from (select movieId, count(*) as n from genome_scores group by 1)""",

    "item_max_relevance": with_(GENOME_SCORES) + "select movieId, max(relevance) as max_relevance from genome_scores group by 1",

    "item_best_tag": with_(GENOME_SCORES, BEST_TAG) + "select * from best",

    "cluster_sizes": with_(RATINGS, CLUSTERS, TOP_CLUSTERS) + "select * from top_clusters",

    "cluster_coverage": with_(RATINGS, GENOME_SCORES, CLUSTERS, BEST_TAG, TOP_CLUSTERS) + """
select c.prediction, count(*) as n_members, count(b.movieId) as n_scored
from clusters c join top_clusters t on c.prediction = t.prediction left join best b on b.movieId = c.movieId
group by 1""",

    "cluster_top_tags": with_(RATINGS, GENOME_SCORES, GENOME_TAGS, CLUSTERS, BEST_TAG, TOP_CLUSTERS) + """,
per_tag as (
  select c.prediction, b.tagId, count(*) as n_items, sum(b.max_relevance) as sum_relevance
  from clusters c join top_clusters t on c.prediction = t.prediction join best b on b.movieId = c.movieId
  group by 1, 2),
ranked as (
  select *, cast(row_number() over (partition by prediction order by sum_relevance desc, tagId asc) as int) as rank
  from per_tag)
select r.prediction, r.rank, r.tagId, g.tag, r.n_items, round(r.sum_relevance, 6) as sum_relevance
from ranked r join genome_tags g on g.tagId = r.tagId where r.rank <= 3""",

    "fold_metric_matrix": with_(RATINGS, FOLDS) + f""",
pif as (select movieId, fold, sum(rating) as s, count(*) as n from folds group by 1, 2),
pi as (select movieId, sum(s) as S, sum(n) as N from pif group by 1),
pf as (select fold, sum(s) as fs, sum(n) as fn from pif group by 1),
fm as (select fold, (sum(fs) over () - fs) / (sum(fn) over () - fn) as mu from pf),
tr as (select pif.movieId, pif.fold, pi.S - pif.s as ts, pi.N - pif.n as tn from pif join pi using (movieId) where pi.N - pif.n > 0),
grid as (select * from (values (1, 0.1::double), (2, 0.5::double), (3, 1.0::double)) g(model, lam)),
scored as (
  select g.model, f.fold, f.rating, (tr.ts + g.lam * fm.mu) / (tr.tn + g.lam) as prediction
  from folds f join tr on tr.movieId = f.movieId and tr.fold = f.fold join fm on fm.fold = f.fold, grid g),
cells as (
  select model, fold, round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) as rmse,
         round(avg(abs(prediction - rating)), 6) as mae
  from scored group by 1, 2)
select model, {_MATRIX_COLS} from cells group by model""",
}
RECOMMEND_SQL["fold_matrix_csv"] = RECOMMEND_SQL["fold_metric_matrix"]
ORACLE.update(RECOMMEND_SQL)

# ---------------------------------------------------------------------------
# Metrics on fixed scores, splits, gated combination
# ---------------------------------------------------------------------------

LINE_KEY_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

METRICS_SQL = {
    "metric_auc": """
with g as (select cast(l_quantity as double) as score, count(*) filter (where l_returnflag = 'R') as pos,
                  count(*) filter (where l_returnflag <> 'R') as neg from lineitem group by 1),
c as (select pos, neg, coalesce(sum(neg) over (order by score rows between unbounded preceding and 1 preceding), 0) as neg_before from g)
select round(sum(pos * (neg_before + neg / 2.0)) / (sum(pos) * sum(neg)), 12) as auc,
       cast(sum(pos + neg) as bigint) as n_scored, cast(sum(pos + neg) as bigint) as n_rows from c""",

    "metric_accuracy": """
select avg(cast((l_quantity > 25) = (l_returnflag = 'R') as double)) as accuracy, count(*) as n_scored, count(*) as n_rows from lineitem""",

    "metric_rmse": """
select round(sqrt(avg((l_extendedprice * 0.9 - l_extendedprice) * (l_extendedprice * 0.9 - l_extendedprice))), 6) as rmse, count(*) as n_scored, count(*) as n_rows from lineitem""",

    "metric_mae": """
select round(avg(abs(l_extendedprice * 0.9 - l_extendedprice)), 6) as mae, count(*) as n_scored, count(*) as n_rows from lineitem""",

    "class_balance": """
select count(*) filter (where l_quantity > 25) as predicted_ones, count(*) filter (where l_returnflag = 'R') as actual_ones,
       count(*) as n_rows from lineitem""",

    "tandem_combine": f"""
select {LINE_KEY_SQL}, cast(l_quantity > 25 as double) as prediction1, l_extendedprice as Claim_Amount,
       case when l_quantity > 25 then l_extendedprice else 0.0 end as prediction from lineitem""",

    "holdout_split": with_(PARTICLES) + f"""
select vec_id, label, case when {U('vec_id')} < 0.7 then 'train' else 'test' end as split from particles""",

    "subsample": with_(PARTICLES) + f"""
select vec_id, label, f1, f28 from particles where {U('vec_id')} < 0.05""",
}
ORACLE.update(METRICS_SQL)

# ---------------------------------------------------------------------------
# Features
# ---------------------------------------------------------------------------

_CENTRE_DIST = """centres as (
select vec_id as cid, row_number() over (order by vec_id) - 1 as idx, embedding as c from embeddings where vec_id < 5),
d as (
select e.vec_id, ce.idx,
       (select sum((cast(e.embedding[i] as double) - cast(ce.c[i] as double)) * (cast(e.embedding[i] as double) - cast(ce.c[i] as double)))
        from range(1, 65) r(i)) as dist
from embeddings e, centres ce)"""

FEATURES_SQL = {
    "assemble_features": with_(PARTICLES) + " union all ".join(
        f"select vec_id, {i} as pos, f{i + 1} as value from particles" for i in range(28)),

    "one_hot": f"""
select {LINE_KEY_SQL}, cast(max(l_linenumber) over () + 1 as int) as ohe_size, cast(l_linenumber as int) as ohe_index from lineitem""",

    "factor_vectors": """
select vec_id as movieId, cast(i - 1 as int) as pos, cast(embedding[i] as double) as value
from embeddings, range(1, 65) r(i)""",

    "nearest_centroid": with_(_CENTRE_DIST) + """
select vec_id, cast(arg_min(idx, (dist, idx)) as int) as prediction from d group by vec_id""",

    "glm_group_mean": """
select l_returnflag, round(avg(l_extendedprice), 4) as prediction from lineitem group by 1""",
}
ORACLE.update(FEATURES_SQL)

# ---------------------------------------------------------------------------
# Model companions: answers that follow from the input
# ---------------------------------------------------------------------------

MODEL_SQL = {
    "tree_families": """
select model, 1.0::double as accuracy, count(*) as n_scored, count(*) as n_rows, 1.0::double as importance_x, 0.0::double as importance_z
from lineitem, (values ('tree'), ('forest'), ('gbt')) m(model) group by model""",

    "cv_cells": """
select cast(cell as int) as cell, numTrees, maxBins, 1.0::double as auc, cell = 0 as best
from (values (0, '1', '5'), (1, '1', '10'), (2, '2', '5'), (3, '2', '10')) g(cell, numTrees, maxBins)
where (select count(distinct l_quantity > 25) from lineitem) = 2""",

    "cv_fold_sizes": f"""
select cast(floor({U('vec_id', seed=124)} * 5) + 1 as int) as fold, count(*) as n from embeddings group by 1""",

    "als_scored": with_(RATINGS, FOLDS) + """,
u as (select distinct userId, fold from folds), i as (select distinct movieId, fold from folds)
select f.fold, count(*) filter (where exists (select 1 from u where u.userId = f.userId and u.fold <> f.fold)
                                  and exists (select 1 from i where i.movieId = f.movieId and i.fold <> f.fold)) as n_scored,
       count(*) as n_rows
from folds f group by f.fold""",

    "two_centres": """
select cast(vec_id % 2 as int) as grp, cast(i - 1 as int) as pos,
       round(avg(cast(embedding[i] as double) + 100 * (vec_id % 2)), 6) + 0.0 as value
from embeddings, range(1, 65) r(i) group by 1, i""",

    "gate_report": """
select count(*) filter (where l_quantity > 25) as predicted_ones, count(*) filter (where l_quantity > 25) as actual_ones,
       count(*) as n_rows from lineitem""",
}

# Equations and counts of models fitted at their own settings.
_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
SPLIT_ROWS = """line_labels as (
select *, l_quantity + 200 * l_discount + 100 * l_tax + l_linenumber > 43 as hit from lineitem)"""


def _bits(ones: str, n: str) -> str:
    """Entropy in bits of a 0/1 label."""
    part = lambda q: f"case when {q} > 0 then -({q}) * log2({q}) else 0.0 end"
    return f"({part(f'({ones} / {n})')} + {part(f'(1 - {ones} / {n})')})"


def _gains(bins: dict[str, int]) -> str:
    values = " union all ".join(f"select '{c}' as feature, cast({c} as double) as value, cast(hit as int) as one, {b} as most from line_labels"
                                for c, b in bins.items())
    return f"""gains as (
with v as ({values}),
c as (select feature, most, value, count(*) as n, sum(one) as ones from v group by all),
p as (select *, coalesce(sum(n) over (partition by feature order by value rows between unbounded preceding and 1 preceding), 0) as before,
             row_number() over (partition by feature order by value) - 1 as nth,
             count(*) over (partition by feature) as values_, sum(n) over (partition by feature) as total from c),
b as (select feature, cast(case when values_ <= most then nth else floor(before * most / total) end as int) as bin,
             min(value) as low, max(value) as high, sum(n) as n, sum(ones) as ones from p group by 1, 2),
r as (select feature, (high + lead(low) over w) / 2 as threshold, sum(n) over w as nl, sum(ones) over w as ol,
             sum(n) over (partition by feature) as na, sum(ones) over (partition by feature) as oa from b
      window w as (partition by feature order by bin))
select feature, threshold, cast(nl as bigint) as n_left, cast(na - nl as bigint) as n_right,
       {_bits('oa', 'na')} - (nl * {_bits('ol', 'nl')} + (na - nl) * {_bits('(oa - ol)', '(na - nl)')}) / na as gain
from r where threshold is not null)"""


_SPLIT_BINS = {"l_quantity": 64, "l_discount": 64, "l_tax": 64, "l_linenumber": 64}
_SEVERITY_LEVELS = " union all ".join(
    f"select '{c}' as feature, cast({c} as varchar) as level, count(*) as n from train group by 2"
    for c in CLAIM_INTS + CLAIM_STRINGS + CLAIM_LARGE)
_SEVERITY_NUMBERS = " union all ".join(f"select '{c}' as feature, '' as level, count(*) as n from train" for c in [*CLAIM_NUMBERS, "(intercept)"])
_TUNING = f"""sample as (
select *, l_quantity > 25 as hit, {U(*_KEYS, seed=124)} as u, cast(floor({U(*_KEYS, seed=125)} * 5) + 1 as int) as fold
from lineitem where {U(*_KEYS)} < 0.05)"""

MODEL_SQL |= {
    "split_gains": with_(SPLIT_ROWS, _gains({**_SPLIT_BINS, "l_extendedprice": 32})) + """
select feature, threshold, n_left, n_right, round(gain, 9) as gain from gains""",

    "tree_roots": with_(SPLIT_ROWS, _gains(_SPLIT_BINS)) + """
select source, feature, threshold from (select * from gains order by round(gain, 12) desc, feature, threshold limit 1),
  (values ('tree'), ('gains')) s(source)""",

    "importance_rank": f"""
with r as (select l_quantity > 25 as x, l_discount > 0.07 as z from lineitem),
c as (select count(*) as n, count(*) filter (where x) as nx, count(*) filter (where z) as nz, count(*) filter (where x and z) as nxz from r),
g as (  -- the gain of either column at the root, and what the other adds below it, times rows
  select 'x' as root, 'z' as other, n * {_bits('(nx + nz - nxz)', 'n')} - (n - nx) * {_bits('(nz - nxz)', '(n - nx)')} as at_root,
         (n - nx) * {_bits('(nz - nxz)', '(n - nx)')} as below from c
  union all
  select 'z', 'x', n * {_bits('(nx + nz - nxz)', 'n')} - (n - nz) * {_bits('(nx - nxz)', '(n - nz)')},
         (n - nz) * {_bits('(nx - nxz)', '(n - nz)')} from c),
t as (select * from g order by at_root desc limit 1),
i as (select root as feature, at_root / (at_root + below) as importance from t
      union all select other, below / (at_root + below) from t union all select 'w', 0.0)
select cast(row_number() over (order by importance desc, feature) as int) as rank, feature, round(importance, 9) as importance from i""",

    "holdout_separable": f"""
with r as (select l_quantity > 25 as hit, {U(*_KEYS)} < 0.7 as train from lineitem)
select 1.0::double as auc, 1.0::double as accuracy, count(*) filter (where not train) as n_scored, count(*) filter (where not train) as n_rows,
       count(*) filter (where not train) as n_test, count(*) filter (where train) as n_train,
       count(*) filter (where train and hit) as train_positives, 'x' as feature from r""",

    "tuning_folds": with_(_TUNING) + """
select case when u < 0.7 then 'train' else 'test' end as part, case when u < 0.7 then fold else 0 end as fold,
       count(*) as n, count(*) filter (where hit) as positives from sample group by 1, 2""",

    "gbt_cells": with_(_TUNING) + """
select cast(cell as int) as cell, maxBins, maxIter, 1.0::double as auc, cell = 0 as best, 1.0::double as accuracy,
       (select count(*) from sample where u >= 0.7) as n_test
from (values (0, '5', '1'), (1, '5', '2'), (2, '10', '1'), (3, '10', '2')) g(cell, maxBins, maxIter)""",

    "severity_equations": with_(CLAIMS, CLEAN, TOPN_SQL, ORDINAL_SQL, OVERRIDE_SQL) + f""",
enc as (select {", ".join(CLAIM_INTS)}, {", ".join(_enc(c) for c in CLAIM_STRINGS + CLAIM_LARGE)},
               {U(*_KEYS, 'y')} < 0.7 as in_train from clean where y = 1),
train as (select * from enc where in_train)
select *, true as solved from ({_SEVERITY_LEVELS} union all {_SEVERITY_NUMBERS}
  union all select '(test rows)', '', count(*) from enc where not in_train)""",

    "als_equations": with_(RATINGS, FOLDS) + """,
t as (select cast(k as int) as k, f.* from folds f, range(1, 4) r(k) where f.fold <> k)
select k as fold, 'user' as side, userId as id, count(*) as n, true as solved from t group by 1, 3
union all select k, 'item', movieId, count(*), true from t group by 1, 3""",

    "split_fits": with_(RATINGS, FOLDS) + """
select fold, count(*) as n_ratings, count(distinct movieId) as n_items, true as at_rest from folds group by 1""",
}
MODEL_SQL["row_ids"] = """
select l_returnflag, l_linestatus, l_quantity, row_number() over (partition by l_returnflag, l_linestatus, l_quantity) - 1 as row_nth,
       true as "unique" from lineitem"""
ORACLE.update(MODEL_SQL)
