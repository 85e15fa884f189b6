"""DuckDB texts for the queries in `__spark_entry__.py`, written independently of the Spark jobs.

Tables are the views the checker registers. Draws are XXH64 over the 8 bytes of a key; the seed of each
draw is the XXH64 of its salt, so both sides agree bit by bit.
"""

from __future__ import annotations

import hashlib
import hmac
from itertools import product

import xxhash

SECRET = "check"
FAVOURED = (8, 44)

WINDOW = ("2024-03-01 10:30:00", 3000)
DAY = ("2020-06-23 11:00:00", 1440)
VOLUME = "(select 10 * count(*) from events)"
EXACT_VOLUME = "(select 3 * count(*) + 7 from events)"
CLASS_SIZE = 5
MEAN_DENSITY = "(select avg(n) / 1440::double from filled)"
USERS = "(select count(distinct user_id) from events)"

# The five primes of XXH64.
P1 = 0x9E3779B185EBCA87
P2 = 0xC2B2AE3D27D4EB4F
P3 = 0x165667B19E3779F9
P4 = 0x85EBCA77C2B2AE63
P5 = 0x27D4EB2F165667C5


def _u(n: int) -> str:
    return f"{n}::uhugeint"


_LOW64 = _u(2**64 - 1)


def _hash(name: str, key: str, salt: str) -> list[str]:
    """Select items, each using the one before; the last one is the 64-bit hash, called `name`."""
    start = (xxhash.xxh64_intdigest(salt.encode(), seed=42) + P5 + 8) % 2**64

    def wrap(text: str) -> str:
        return f"({text}) & {_LOW64}"

    def rotate(var: str, by: int) -> str:
        return f"(({var} << {by}) & {_LOW64} | ({var} >> {64 - by}))"

    a, b, c, d, e = (f"{name}_{x}" for x in "abcde")
    return [
        f"{wrap(f'({key})::uhugeint * {_u(P2)}')} as {a}",
        f"xor({_u(start)}, {wrap(f'{rotate(a, 31)} * {_u(P1)}')}) as {b}",
        f"{wrap(f'({wrap(f'{rotate(b, 27)} * {_u(P1)}')}) + {_u(P4)}')} as {c}",
        f"{wrap(f'xor({c}, {c} >> 33) * {_u(P2)}')} as {d}",
        f"{wrap(f'xor({d}, {d} >> 29) * {_u(P3)}')} as {e}",
        f"xor({e}, {e} >> 32) as {name}",
    ]


def draws(source: str, key: str, **salts: str) -> str:
    """The source with one 53-bit number per named draw."""
    items = []
    for name, salt in salts.items():
        items += [*_hash(f"{name}_h", key, salt), f"({name}_h >> 11)::bigint as {name}"]
    return f"select *, {', '.join(items)} from {source}"


def query(select: str, **ctes: str) -> str:
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in ctes.items()) + "\n" + select


def dotted(number: str) -> str:
    return "concat_ws('.', " + ", ".join(f"(({number} >> {s}) & 255)::varchar" for s in (24, 16, 8, 0)) + ")"


# Traffic

PROFILE = """select s.slot::integer as slot, coalesce(e.n, 0)::bigint as n
from (select unnest(generate_series(0, 1439)) as slot) s left join (
  select ((hour(ts) * 60 + minute(ts) - 660) % 1440 + 1440) % 1440 as slot, count(*) as n from events group by 1
) e on s.slot = e.slot"""


def window(start: str, minutes: int) -> str:
    first = f"timestamp '{start}'"
    return f"""select w.i::integer as i, {first} + to_minutes(w.i) as minute_ts, p.slot, p.n
from (select unnest(generate_series(0, {minutes - 1})) as i) w
join profile p on p.slot = (w.i + hour({first}) * 60 + minute({first}) - 660 + 1440) % 1440"""


ALLOCATION = f"""select w.*, round_even(n * ({VOLUME}::double / (select sum(n) from win)::double), 0)::bigint as c
from win w"""

UNITS = "select i, minute_ts, unnest(generate_series(1, c)) as k from alloc where c > 0"
ROWS = "select i::bigint * 1099511627776 + k as id, i, k::bigint as k, minute_ts from units"


def traffic(span: tuple[str, int]) -> dict[str, str]:
    return {"profile": PROFILE, "win": window(*span), "alloc": ALLOCATION, "units": UNITS, "numbered": ROWS}


def ticks(every: str) -> dict[str, str]:
    return {
        "counts": f"select time_bucket(interval '{every}', ts) as tick, count(*) as n from events group by 1",
        "spine": f"select unnest(generate_series(min(tick), max(tick), interval '{every}')) as tick from counts",
        "filled": "select s.tick, coalesce(c.n, 0)::bigint as n from spine s left join counts c on s.tick = c.tick",
    }


# Lists

HOST = "regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)"
HOSTS = f"select distinct {HOST} as host from pages where {HOST} <> ''"

PORT_TEXT = """select p_partkey as pos, case when p_partkey % 7 = 0 then null
  when p_partkey % 5 = 0 then p_partkey || '-' || (p_partkey + 3) else p_partkey::varchar end as raw from part"""
CLEAN = r"""select port, min(pos) as pos from (
  select pos, case when regexp_matches(raw, '^\s*[+-]?\d+\s*$') then try_cast(raw as integer) end as port from port_text
) where port is not null group by port"""
PREFERRED = f"""select (row_number() over (order by case port when {FAVOURED[0]} then 0 when {FAVOURED[1]} then 1 else 2 end, pos)
  - 1)::bigint as pos, port from clean"""
WEIGHTED = """select *, (case when pos < 2 then 2 * ((select count(*) from preferred) - 2) else 1 end)::bigint as w
from preferred"""
WEIGHTS = "select pos, port, w, (sum(w) over (order by pos))::bigint as hi from weighted"
PORTS = {"port_text": PORT_TEXT, "clean": CLEAN, "preferred": PREFERRED, "weighted": WEIGHTED, "weights": WEIGHTS}


def port_at(draw: str) -> str:
    """Position of the port that holds a ticket: two ports of 2 * m tickets, then m ports of one ticket each."""
    others = "((select count(*) from weights) - 2)"
    ticket = f"({draw} % (select max(hi) from weights))"
    return f"""case when {ticket} < 4 * {others} then {ticket} // (2 * {others}) else 2 + {ticket} - 4 * {others} end"""


# Entities

KEYED = f"""select user_id as key, ('0x' || substr(sha256('{SECRET}:' || user_id), 1, 13))::bigint % 4294967295 + 1 as ip_number
from (select distinct user_id from events)"""
ADDRESSES = f"""select (row_number() over (order by key) - 1)::bigint as pos, key, ip_number, {dotted('ip_number')} as ip,
  count(*) over (partition by ip_number) as same_ip from keyed"""
POOL = f"""select (row_number() over (order by min(key)) - 1)::bigint as pos, ip_number, {dotted('ip_number')} as ip,
  count(*) as same_ip from keyed group by ip_number"""
PLACED_HOSTS = "select host, row_number() over (order by host) - 1 as host_pos from hosts"


def assigned(source: str) -> dict[str, str]:
    return {
        "host_drawn": draws(source, "ip_number", host="host"),
        "placed_hosts": PLACED_HOSTS,
        "assigned": f"""select d.*, p.host as known_host from (select * rename (host as host_draw) from host_drawn) d
join placed_hosts p on p.host_pos = d.host_draw % (select count(*) from hosts)""",
    }


CLASSED = {
    "labelled": draws("assigned", "ip_number", letters="label", size="label length"),
    "dim": f"""select pos, ip_number, ip, same_ip, case class when 0 then 'generated' when 1 then 'missing' else 'known' end as class,
  case when class = 0 then left(right(lower(to_base((letters_h >> 1)::bigint, 36, 13)), 10), (5 + size % 6)::integer) || 'DGA.com'
       when class > 1 then known_host end as host from (select *, pos // {CLASS_SIZE} as class from labelled)""",
}
ADDRESS_DIM = {"hosts": HOSTS, "keyed": KEYED, "addresses": ADDRESSES}
POOL_DIM = {"hosts": HOSTS, "keyed": KEYED, "pool": POOL, **assigned("pool"), **CLASSED}


def ends(source: str, key: str, n: str) -> str:
    return f"""select *, src_draw % {n} as src, (src_draw % {n} + 1 + dst_draw % ({n} - 1)) % {n} as dst
from ({draws(source, key, src_draw='source', dst_draw='destination')})"""


ENRICH = """s.ip as "source_IP", s.host as "source_domainName", d.ip as "destination_IP", d.host as "destination_domainName\""""

# Flows

DIM_SIZE = "(select count(*) from dim)"
FLOW_CTES = {
    **traffic(DAY),
    **POOL_DIM,
    **PORTS,
    "drawn": draws(
        "numbered",
        "id",
        ms="offset",
        proto="protocol",
        size="bytes",
        sport="source port",
        dport="destination port",
    ),
    "ported": f"select *, {port_at('sport')} as sport_pos, {port_at('dport')} as dport_pos from drawn",
    "paired": ends("ported", "id", DIM_SIZE),
    "flows": f"""select f.id, (15000 + size % 285001) / 10::double as bytes,
  ceil((15000 + size % 285001) / 10::double / 1500)::bigint as packets, (proto % 144)::integer as protocol,
  s.ip as "source_IP", s.host as "source_domainName", ps.port as source_port,
  d.ip as "destination_IP", d.host as "destination_domainName", pd.port as destination_port,
  minute_ts + to_milliseconds(ms % 60000) as "timestamp"
from paired f join dim s on s.pos = f.src join dim d on d.pos = f.dst
join weights ps on ps.pos = f.sport_pos join weights pd on pd.pos = f.dport_pos""",
}
SUPPLY = "select 's' || l_suppkey as \"source_IP\", 'p' || l_partkey as \"destination_IP\" from lineitem"
SOME_TIMES = "select * replace (case when event_id % 10 > 0 then ts end as ts) from events"


def keyed(key: str) -> str:
    return f"('0x' || substr(sha256('{SECRET}:' || {key}), 1, 13))::bigint % 4294967295 + 1"


SUPPLY_FLOWS = f"""select l_extendedprice as bytes, ceil(l_extendedprice / 1500)::bigint as packets,
  {dotted('source')} as "source_IP", {dotted('destination')} as "destination_IP", l_shipdate as "timestamp"
from (select *, {keyed("'s' || l_suppkey")} as source, {keyed("'p' || l_partkey")} as destination from lineitem)"""
EDGES = 'select "source_IP" as src, "destination_IP" as dst, count(*) as n from flows group by 1, 2'
NODES = """select node, sum(o)::bigint as out_degree, sum(i)::bigint as in_degree from (
  select src as node, 1 as o, 0 as i from edges union all select dst, 0, 1 from edges) group by node"""


CENTS = "value::decimal(18,2)::varchar"
EVENT_TEXTS = {
    "event_id": "event_id::varchar",
    "long_id": "(event_id * 1000000007)::varchar",
    "ts": "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')",
    "day": "case when event_id % 7 > 0 then strftime(ts, '%Y-%m-%d') end",
    "cents": CENTS,
    "kind": "event_type",
    "mostly_number": "case when event_id % 1000 = 999 then 'n/a' else event_id::varchar end",
    "mostly_day": "case when event_id % 500 = 499 then '2024-02-30' else strftime(ts, '%Y-%m-%d') end",
    "scientific": f"{CENTS} || 'e' || (event_id % 9)::varchar",
    "nothing": "null::varchar",
}


def inferred(texts: dict[str, str]) -> str:
    """Types by counting the values that do not fit, column by column."""
    fixed = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
    parts = [rf"length(regexp_extract(v, '^[+-]?0*([0-9]*)\.?([0-9]*)$', {k}))" for k in (1, 2)]
    fits = {
        "int": "regexp_matches(v, '^[+-]?[0-9]+$') and try_cast(v as integer) is not null",
        "bigint": "regexp_matches(v, '^[+-]?[0-9]+$') and try_cast(v as bigint) is not null",
        "decimal": f"regexp_matches(v, '{fixed}') and {parts[0]} + {parts[1]} <= 38",
        "double": f"regexp_matches(v, '{fixed[:-1]}([eE][+-]?[0-9]{{1,3}})?$')",
        "date": "regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') and try_cast(v as date) is not null",
        "timestamp": r"regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?)?$') and try_cast(v as timestamp) is not null",
    }
    counts = ", ".join(f"count(*) filter (v is not null and not ({fit})) as not_{kind}" for kind, fit in fits.items())
    sizes = ", ".join(
        f"coalesce(max({part}) filter (regexp_matches(v, '{fixed}')), 0)::bigint as {name}"
        for part, name in zip(parts, ("whole_digits", "fraction_digits"), strict=True)
    )
    every = " union all ".join(f"select '{name}' as column, {text} as v from events" for name, text in texts.items())
    # A date is also a timestamp, a whole number also a decimal; the narrowest one counts.
    return f"""select "column", case when n_values = 0 then 'string' when not_int = 0 then 'int' when not_bigint = 0 then 'bigint'
  when not_decimal = 0 and whole_digits + fraction_digits <= 38
    then 'decimal(' || greatest(whole_digits + fraction_digits, 1) || ',' || fraction_digits || ')'
  when not_double = 0 then 'double' when not_date = 0 then 'date' when not_timestamp = 0 then 'timestamp_ntz' else 'string' end as type,
  n_values, n_nulls, not_int, not_bigint, not_decimal, not_double, not_date, not_timestamp, whole_digits, fraction_digits
from (select "column", count(v) as n_values, count(*) - count(v) as n_nulls, {counts}, {sizes} from ({every}) group by 1)"""


def _keys(purpose: str, count: int) -> list[str]:
    return [hmac.new(SECRET.encode(), f"{purpose} {k}".encode(), hashlib.sha256).hexdigest() for k in range(count)]


def permuted(rows: str, number: str, name: str) -> str:
    """Eight balanced rounds over the halves of a number below 2**32; no number of these tables comes out as 0."""
    out = f"select *, {number} >> 16 as l, {number} & 65535 as r from ({rows})"
    for key in _keys("rank", 8):
        turned = f"xor(l, ('0x' || substr(sha256('{key}:' || r::varchar), 1, 4))::bigint)"
        out = f"select * replace (r as l, {turned} as r) from ({out})"
    return f"select * exclude (l, r), l * 65536 + r as {name} from ({out})"


RANKED = "select (row_number() over (order by key) - 1)::bigint as pos, key from (select distinct user_id as key from events where user_id is not null)"
[PREFIX_KEY] = _keys("prefix", 1)
HIDDEN_BIT = f"""(b.bits[i + 1]::bigint + ('0x' || substr(sha256('{PREFIX_KEY}:' || left(b.bits, i::integer)), 1, 1))::bigint) % 2"""


def released(levels: dict[str, list[str]], k: int) -> str:
    """All choices of levels with their smallest groups; the groups of the one that loses least."""
    parts = []
    for choice in product(*[range(len(own)) for own in levels.values()]):
        columns = ", ".join(f"{levels[n][i]} as {n}" for n, i in zip(levels, choice, strict=True))
        loss = sum(i / (len(levels[n]) - 1) for n, i in zip(levels, choice, strict=True))
        parts.append(f"select {loss:.9f} as loss, '{choice}' as choice, {columns}, count(*) as n from lineitem group by all")
    return f"""with groups as ({" union all ".join(parts)}), sizes as (
  select loss, choice from groups group by 1, 2 having min(n) >= {k} order by 1, 2 limit 1
) select {", ".join(levels)}, n from groups semi join sizes using (choice)"""


RELEASED = released(
    {
        "supplier": ["'s' || l_suppkey", "'s' || (l_suppkey % 10)", "'*'"],
        "time": ["strftime(l_shipdate, '%Y-%m-%d')", "strftime(l_shipdate, '%Y-%m')", "year(l_shipdate)::varchar", "'*'"],
        "amount": [*[f"floor(l_extendedprice / {step})::bigint::varchar" for step in (1000, 10_000, 100_000)], "'*'"],
    },
    10,
)
KEYED_LAST = f"select {HOST} as host, min(page_id) as pos, max_by(url, page_id) as url from pages group by 1"
FIDELITY_COLUMNS = {
    "l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "l_discount": "l_discount", "part": "l_partkey::double",
    "day": "(year(l_shipdate) * 366 + dayofyear(l_shipdate))::double",
}
LONG_LINES = " union all ".join(f"select '{name}' as column, {v} as v, l_orderkey % 2 = 0 as out from lineitem" for name, v in FIDELITY_COLUMNS.items())
FIDELITY = f"""
with long as ({LONG_LINES}), ends as (
  select "column", min(v) as low, max(v) as high from long group by 1
), bars as (
  select "column", case when v is null then -1 when high > low then least(floor((v - low) / ((high - low) / 200.0::double)), 199) else 0 end as bin,
    count(*)::hugeint as o, (count(*) filter (out))::hugeint as r
  from long join ends using ("column") group by 1, 2
), sums as (
  select *, sum(o) over all_of as n, sum(r) over all_of as m from bars window all_of as (partition by "column")
), gaps as (
  select *, o * m - r * n as gap, sum(o * m - r * n) over (partition by "column" order by bin) as running from sums
)
select "column", any_value(n)::bigint as n_original, any_value(m)::bigint as n_released,
  max(abs(running))::double / any_value(n * m)::double as ks,
  sum(abs(gap))::double / any_value(n * m)::double / 2 as total_variation,
  sum(floor(gap::double * gap::double / (n * m)::double / (o + r)::double * 1000000)::bigint)::double / 1000000 as chi_square,
  max(greatest(o::double / n::double, r::double / m::double)) as ks_error
from gaps group by 1
"""


def oracle_sql() -> dict[str, str]:
    t = traffic(WINDOW)
    start, end = "strftime(window_start, '%d%m%Y_%H%M')", "strftime(window_end, '%d%m%Y_%H%M')"
    both = "case when {0} is null then 'missing' when {0} like '%DGA.com' then 'generated' end"
    source_flag, destination_flag = both.format('"source_domainName"'), both.format('"destination_domainName"')
    exact = {
        "profile": PROFILE,
        "win": window(*WINDOW),
        "parts": f"""select *, n::hugeint * {EXACT_VOLUME} // (select sum(n) from win) as base,
  n::hugeint * {EXACT_VOLUME} % (select sum(n) from win) as rest from win""",
        "ranked": "select *, row_number() over (order by rest desc, i) as rank from parts",
    }
    return {
        "csv_roundtrip": "select * from events",
        "export_manifest": f"""select 'flows_' || {start} || '_to_' || {end} as path_label, window_start, window_end, n
from (select time_bucket(interval '1 day', ts) as window_start,
  time_bucket(interval '1 day', ts) + interval 1 day as window_end, count(*) as n from events group by 1, 2)""",
        "typed_projection": """select c_custkey, case when c_nationkey % 5 > 0 then c_acctbal end as c_acctbal,
  c_nationkey, c_name, null::bigint as c_mktsegment from customer""",
        "positional_zip": """select l.pos::bigint as pos, event_id, user_id, value_event_id, value
from (select row_number() over (order by event_id) - 1 as pos, event_id, user_id from events) l
join (select row_number() over (order by value, event_id) - 1 as pos, event_id as value_event_id, value from events) r
on l.pos = r.pos""",
        "host_list": HOSTS,
        "first_seen_distinct": "select p_brand, min(p_partkey) as pos from part group by p_brand",
        "port_clean": query("select port, pos from clean", **PORTS),
        "preferred_first": query("select pos, port from preferred", **PORTS),
        "weight_table": query("select pos, port, w, hi from weights", **PORTS),
        "keyed_last_wins": KEYED_LAST,
        "minute_profile": PROFILE,
        "profile_window": query("select * from win", **t),
        "volume_allocation": query("select * from alloc", **t),
        "volume_total": query(
            f"""select {VOLUME}::bigint as requested, sum(c)::bigint as allocated,
  ({VOLUME} - sum(c))::bigint as lost from alloc""",
            **t,
        ),
        "volume_allocation_exact": query(
            f"""select i, minute_ts, slot, n,
  (base + case when rank <= {EXACT_VOLUME} - (select sum(base) from parts) then 1 else 0 end)::bigint as c from ranked""",
            **exact,
        ),
        "density_check": query(
            f"""select tick as window_start, n, n / 1440::double as per_minute,
  {MEAN_DENSITY} as min_per_minute, n / 1440::double >= {MEAN_DENSITY} as passes from filled""",
            **ticks("1 day"),
        ),
        "row_expansion": query("select * from numbered", **t),
        "minute_jitter": query(
            """select id, i, ts, row_number() over (partition by i order by ts, id) as nth,
  strftime(ts, '%d/%m/%Y %H:%M:%S.%g') as ts_text
from (select *, minute_ts + to_milliseconds(ms % 60000) as ts from drawn)""",
            **t,
            drawn=draws("numbered", "id", ms="offset"),
        ),
        "expected_vs_actual": query(
            """select a.i, a.minute_ts, a.n, a.n / (select sum(n) from win)::double as expected_share,
  a.c as actual_rows, a.n * ((select sum(c) from alloc)::double / (select sum(n) from win)::double) as expected_rows,
  a.c - a.n * ((select sum(c) from alloc)::double / (select sum(n) from win)::double) as difference from alloc a""",
            **t,
        ),
        "tick_rollup": query("select tick, strftime(tick, '%H:%M') as label, n from filled", **ticks("5 minutes")),
        "address_dim": query("select * from addresses", **ADDRESS_DIM),
        "domain_assign": query(
            "select pos, key, ip_number, ip, same_ip, known_host as host from assigned",
            **ADDRESS_DIM,
            **assigned("addresses"),
        ),
        "domain_class": query("select pos, ip_number, ip, same_ip, host, class from dim", **POOL_DIM),
        "flag_generated": query(
            f"""select * from (select *, {source_flag} as source_flag, {destination_flag} as destination_flag from flows)
where source_flag is not null or destination_flag is not null""",
            **FLOW_CTES,
        ),
        "endpoint_pairs": query(
            "select event_id, src, dst from paired", paired=ends("events", "event_id", USERS)
        ),
        "endpoint_enrich": query(
            f"""select event_id, {ENRICH} from paired p join dim s on s.pos = p.src join dim d on d.pos = p.dst""",
            **POOL_DIM,
            paired=ends("events", "event_id", DIM_SIZE),
        ),
        "bucket_assign": query(
            "select event_id, (h % 144)::integer as protocol from drawn",
            drawn=draws("events", "event_id", h="protocol"),
        ),
        "size_fields": query(
            """select event_id, (15000 + h % 285001) / 10::double as bytes,
  ceil((15000 + h % 285001) / 10::double / 1500)::bigint as packets from drawn""",
            drawn=draws("events", "event_id", h="bytes"),
        ),
        "size_fields_amount": """select l_orderkey, l_linenumber, l_extendedprice as bytes,
  ceil(l_extendedprice / 1500)::bigint as packets from lineitem""",
        "weighted_assign": query(
            """select event_id, user_id, ps.port as source_port, pd.port as destination_port from ported f
join weights ps on ps.pos = f.s_pos join weights pd on pd.pos = f.d_pos""",
            **PORTS,
            drawn=draws("events", "event_id", s="source port", d="destination port"),
            ported=f"select *, {port_at('s')} as s_pos, {port_at('d')} as d_pos from drawn",
        ),
        "flow_table": query("select * exclude (id) from flows", **FLOW_CTES),
        "flow_preview": query('select * from flows order by "timestamp", id limit 20', **FLOW_CTES),
        "flow_edges": query("select * from edges", **FLOW_CTES, edges=EDGES),
        "flow_nodes": query(NODES, **FLOW_CTES, edges=EDGES),
        "flow_edges_supply": query("select * from edges", flows=SUPPLY, edges=EDGES),
        "flow_nodes_supply": query(NODES, flows=SUPPLY, edges=EDGES),
        "csv_documents": "select * from documents",
        "export_roundtrip": f"""select * exclude (window_start, window_end),
  coalesce('flows_' || {start} || '_to_' || {end}, 'flows_no_time') as path_label
from (select *, date_trunc('day', ts) as window_start, date_trunc('day', ts) + interval 1 day as window_end
  from ({SOME_TIMES}))""",
        "export_manifest_no_time": f"""select coalesce('flows_' || {start} || '_to_' || {end}, 'flows_no_time') as path_label, window_start, window_end, n
from (select date_trunc('day', ts) as window_start, date_trunc('day', ts) + interval 1 day as window_end, count(*) as n
  from ({SOME_TIMES}) group by 1, 2)""",
        "port_clean_csv": query(
            "select port, pos from clean",
            port_text=f"select (row_number() over (order by pos) - 1)::bigint as pos, raw from ({PORT_TEXT})",
            clean=CLEAN,
        ),
        "expected_vs_counted": query(
            """select (i)::integer as i, minute_ts, n, n / whole as expected_share, c as actual_rows,
  n * (total / whole) as expected_rows, c - n * (total / whole) as difference
from (select *, sum(n) over ()::double as whole, sum(c) over ()::double as total from (
  select m.i, m.minute_ts, coalesce(p.n, 0)::bigint as n, coalesce(a.c, 0)::bigint as c from minutes m
  left join (select hour(ts) * 60 + minute(ts) as slot, count(*) as n from events, halves where ts < middle group by 1) p
    on p.slot = hour(m.minute_ts) * 60 + minute(m.minute_ts)
  left join (select date_trunc('minute', ts) as at, count(*) as c from events, halves where ts >= middle group by 1) a
    on a.at = m.minute_ts))""",
            days="select date_trunc('day', min(ts)) as first, date_trunc('day', max(ts)) + interval 1 day as past from events",
            halves="select past, first + to_days((date_diff('day', first, past) // 2)::integer) as middle from days",
            minutes="""select i, middle + to_minutes(i) as minute_ts
from (select middle, unnest(generate_series(0, date_diff('minute', middle, past) - 1)) as i from halves)""",
        ),
        "event_order": """select event_id, user_id, ts::date as day,
  row_number() over (partition by ts::date order by ts, event_id) as nth from events""",
        "csv_foreign_records": "select doc_id, lang, text, n_chars::bigint as n_chars from documents",
        "inferred_types": inferred(EVENT_TEXTS),
        "distinct_addresses": f"""select pos, key, ip_number,
  (ip_number >> 24) || '.' || ((ip_number >> 16) & 255) || '.' || ((ip_number >> 8) & 255) || '.' || (ip_number & 255) as ip
from ({permuted(RANKED, "(pos + 1)", "ip_number")})""",
        "hidden_prefixes": f"""select number, sum({HIDDEN_BIT} * (1::bigint << (31 - i)::integer))::bigint as hidden
from (select number, right(number::bit::varchar, 32) as bits from (
  select distinct o_custkey * 2654435761 % (1 << 30) * 4 + o_orderkey % 4 as number from orders)) b, range(32) t(i)
group by number""",
        "top_nodes": """select row_number() over (order by n desc, node) as rank, node, n
from (select node, count(*) as n from (
  select 's' || l_suppkey::varchar as node from lineitem union all select 'p' || l_partkey::varchar from lineitem) group by 1)
qualify rank <= 20""",
        "events_in_windows": """select w.event_id as window_id, count(*) as n_events, count(distinct e.user_id) as n_users
from events w join events e on e.ts >= w.ts and e.ts < w.ts + to_minutes(ceil(w.value)::bigint)
where w.event_type = 'purchase' group by 1""",
        "supplier_parts": """select l_suppkey as node, month + k as window, count(distinct l_partkey) as n
from (select l_suppkey, l_partkey, year(l_shipdate) * 12 + month(l_shipdate) as month from lineitem), range(3) t(k)
group by 1, 2""",
        "flow_fidelity": FIDELITY,
        "keyed_batches": KEYED_LAST,
        "released_groups": RELEASED,
        "supply_flows": SUPPLY_FLOWS,
        "supply_flow_edges": query("select * from edges", flows=SUPPLY_FLOWS, edges=EDGES),
        "supply_flow_nodes": query(NODES, flows=SUPPLY_FLOWS, edges=EDGES),
        "supply_flow_preview": query(
            """select * from flows order by "timestamp", bytes, packets, "source_IP", "destination_IP" limit 20""", flows=SUPPLY_FLOWS
        ),
    }
