"""DuckDB SQL for each registered job (the driver's correctness oracle).

Views mirror :mod:`vaultlens.plans.bindings`; they are spelled as CTEs so each
oracle string runs on the driver's pre-registered tables alone.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["inv_x"] = r"""
inv_x AS (
  select archiveid, creationdate, size, base, ln, ok, rf, ls, sha256(archiveid) AS sha256treehash,
    case ln when 2 then '<m><v>4</v><p>' || base64(encode(base)) || ' </p><lm>x</lm></m>'
            when 3 then '{"Path":"' || base || '","UTCDateModified":"x"}'
            when 4 then replace(base, '/', '\')
            when 5 then '   '
            when 6 then '"<ArchiveMetadata>  <Path>  ' || base64(encode(base)) || '  </Path></ArchiveMetadata>"'
            when 7 then '{"Path":"   "}'
            when 1 then case ok % 7 when 1 then '<m><p>!' || replace(base64(encode(base)), '=', '') || '*</p></m>'
                                    when 2 then '{"Path":"' || base || '"}}' when 3 then '{"Path":"' || base || '"} {"x":1}'
                                    when 4 then '<m><p>6Q==</p></m>' when 5 then base || '-1995-06-17' else base end
            else base end AS archivedescription,
    case when ln in (5, 7) then '00undefined/' || archiveid
         when ln = 1 and ok % 7 = 2 then '{"Path":"' || base || '"}}'
         when ln = 1 and ok % 7 = 3 then '{"Path":"' || base || '"} {"x":1}'
         when ln = 1 and ok % 7 = 4 then chr(65533)
         when ln = 1 and ok % 7 = 5 then base || '-1995-06-17' else base end AS nm
  from (select concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar),
                              cast(l_partkey as varchar), cast(l_suppkey as varchar)) AS archiveid,
               strftime(l_shipdate, '%Y-%m-%d') AS creationdate,
               cast(l_quantity as bigint) * 268435456 AS size,
               concat('set', cast(l_partkey % 50 as varchar), '/obj', cast(l_suppkey % 10 as varchar)) AS base,
               l_linenumber AS ln, l_orderkey AS ok, l_returnflag AS rf, l_linestatus AS ls
        from lineitem) z
)"""

VIEWS["ovr"] = r"""
ovr AS (
  select archiveid, case when ln % 4 = 1 then '   ' when ln % 4 = 2 then '' when ln % 4 = 3 then null
                         else 'ovr/' || base end AS override
  from inv_x where rf = 'R'
  union all
  select archiveid, 'zz/' || base from inv_x where rf = 'R' and ls = 'O'
)"""

VIEWS["numbered"] = r"""
numbered AS (
  select *, row_number() over (order by creationdate, archiveid) AS row_num from inv_x
)"""

VIEWS["psize"] = r"""
psize AS (
  select case when ceil(v / 65970697666560.0) * 160000 < n then 10000
              else cast(ceil(n / 16.0 / ceil(v / 65970697666560.0)) as bigint) end AS psize
  from (select count(*) AS n, coalesce(cast(sum(size) as bigint), 0) AS v from inv_x) s
)"""

VIEWS["dovr"] = r"""
dovr AS (
  select archiveid, coalesce(min(case when length(trim(override)) > 0 then override end), min(override)) AS override
  from ovr group by archiveid
)"""

VIEWS["parted"] = r"""
parted AS (
  select r.archiveid, r.creationdate, r.size, r.sha256treehash, r.row_num, r.base, r.ln, r.ok, r.nm,
         case when length(trim(d.override)) > 0 then d.override else r.archivedescription end AS archivedescription,
         case when length(trim(d.override)) > 0 then 1 else 0 end AS ov,
         r.row_num // p.psize AS part
  from numbered r left join dovr d on r.archiveid = d.archiveid cross join psize p
)"""

# Resolved names (``nm``) follow from how the descriptions were built; overrides replace
# the description first.
VIEWS["named"] = r"""
named AS (
  select *, case when ov = 1 then replace(trim(archivedescription), '\', '/')
                 else nm end AS fname0
  from parted
)"""

_DEPS = {
    "inv_x": [], "ovr": ["inv_x"], "numbered": ["inv_x"], "psize": ["inv_x"], "dovr": ["ovr"],
    "parted": ["numbered", "dovr", "psize"], "named": ["parted"],
}


def with_views(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    head = "WITH " + ",\n".join(VIEWS[n].strip() for n in order)
    body = body.lstrip()
    # A body starting with ", name AS (...)" adds its own CTEs after the views.
    return head + ("\n" if body.startswith(",") else "\n") + body


ORACLE: dict[str, str] = {}

ORACLE["inventory_summary"] = with_views(
    "select count(*) AS archive_count, coalesce(cast(sum(size) as bigint), 0) AS vault_bytes from inv_x", "inv_x")

ORACLE["global_numbering"] = with_views(
    "select archiveid, cast(row_num as bigint) AS row_num from numbered", "numbered")

ORACLE["partition_plan"] = with_views(
    """select cast(part as bigint) AS part, count(*) AS n, cast(sum(size) as bigint) AS bytes,
              cast(min(row_num) as bigint) AS lo, cast(max(row_num) as bigint) AS hi,
              cast(sum(ov) as bigint) AS overridden
       from parted group by part""", "parted")

ORACLE["resolve_names"] = with_views(
    "select archiveid, nm AS fname from inv_x",
    "inv_x")

VIEWS["status_l"] = r"""
status_l AS (
  select aid, l_linestatus, l_returnflag, sz from (
    select concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar),
                     cast(l_partkey as varchar), cast(l_suppkey as varchar)) AS aid,
           l_linestatus, l_returnflag, cast(l_quantity as bigint) * 268435456 AS sz,
           row_number() over (partition by l_orderkey, l_linenumber, l_partkey, l_suppkey
                              order by l_shipdate desc, l_quantity desc) AS rn
    from lineitem) q where rn = 1
)"""
_DEPS["status_l"] = []

# A first row is suffixed too if its name equals the suffixed name of an earlier row. (Names
# made that way carry two dates and meet no other, so one step is the whole fixpoint.)
VIEWS["uniq"] = r"""
uniq0 AS (select *, row_number() over (partition by fname0 order by row_num) AS k from named),
sfx AS (select fname0 || '-' || creationdate AS sname, min(row_num) AS srow from uniq0 where k > 1 group by 1),
uniq AS (
  select uniq0.*, case when k > 1 or coalesce(srow < row_num, false)
                       then fname0 || '-' || creationdate else fname0 end AS fname
  from uniq0 left join sfx on k = 1 and sname = fname0
)"""
_DEPS["uniq"] = ["named"]

ORACLE["unique_names"] = with_views(
    "select archiveid, cast(row_num as bigint) AS row_num, fname from uniq", "uniq")

ORACLE["status_records"] = with_views(
    """select archiveid AS aid, cast(row_num as bigint) AS ifn, cast(part as bigint) AS pid,
              sha256treehash AS sha, size AS sz, archivedescription AS descr, fname,
              cast((size + 4294967295) // 4294967296 as integer) AS cc, 0 AS rc,
              '2024-01-01T00:00:00+00:00' AS cdt
       from uniq""", "uniq")

ORACLE["resume_requests"] = with_views(
    """, rec AS (select i.archiveid from inv_x i join orders o on i.ok = o.o_orderkey where o.o_orderstatus = 'F'),
       lastp AS (select part, max(row_num) AS max_ifn, arg_max(archiveid, row_num) AS last_aid
                 from parted where archiveid in (select archiveid from rec) group by part)
       select p.part, cast(coalesce(l.max_ifn, 0) as bigint) AS max_ifn, l.last_aid,
              cast(sum(case when p.row_num > coalesce(l.max_ifn, 0) then 1 else 0 end) as bigint) AS remaining,
              cast(coalesce(sum(case when p.row_num > coalesce(l.max_ifn, 0) then p.size end), 0) as bigint) AS remaining_bytes,
              cast(sum(p.size) as bigint) AS bytes
       from parted p left join lastp l on p.part = l.part
       group by p.part, l.max_ifn, l.last_aid""", "parted")

# Late throttling counts for the partition whose wait finds it; requests take their own time.
ORACLE["request_pacing"] = with_views(
    """, thr AS (select p.part + e.event_id % 3 AS part, sum(p.size) AS tb, count(*) AS errs
                 from events e join parted p on p.row_num = e.user_id where e.event_type = 'error' group by 1),
       pb AS (select part, cast(sum(size) as bigint) AS bytes, count(*) AS n, count(*) * (cast(part as bigint) % 5) * 3 AS elapsed_s
              from parted group by part),
       w AS (select pb.part, pb.bytes, pb.n, elapsed_s, cast(coalesce(thr.tb, 0) as bigint) AS throttled_bytes,
                    cast(coalesce(thr.errs, 0) as bigint) AS errors from pb left join thr on pb.part = thr.part),
       w2 AS (select *, greatest(cast(floor(86400.0 * ((bytes + throttled_bytes) / 65970697666560.0) + 0.5) as bigint) - elapsed_s, 0) AS w0 from w),
       w3 AS (select *, cast(case when w0 = 0 and throttled_bytes > 0 then 960 else w0 end as bigint) AS wait_s from w2)
       select part, bytes, n, throttled_bytes, errors, cast(elapsed_s as bigint) AS elapsed_s, wait_s,
              cast(coalesce(sum(elapsed_s + wait_s) over (order by part rows between unbounded preceding and 1 preceding), 0) as bigint) AS start_s
       from w3""", "parted")

ORACLE["throttle_drain"] = with_views(
    """, t AS (select p.size from events e join parted p on p.row_num = e.user_id
               where e.event_type = 'error' and p.part + e.event_id % 3 > (select max(part) from parted))
       select 'throttling' AS pk, 'throttledBytes' AS counter, cast(coalesce(sum(size), 0) as bigint) AS value from t
       union all select 'throttling', 'errorCount', count(*) from t""", "parted")

_C4 = 4294967296
_C2 = 2147483648

ORACLE["copy_chunk_plan"] = with_views(
    f""", s AS (select archiveid AS aid, size AS sz, cast((size + {_C4 - 1}) // {_C4} as integer) AS cc from inv_x),
       x AS (select aid, sz, cc, greatest(cc, 1) AS n,
                    unnest(generate_series(1, case when cc <= 1 then 1 else greatest(cc, 1) end)) AS g from s)
       select aid, case when cc <= 1 then null else cast(g as integer) end AS part_no,
              case when cc <= 1 then null else (g - 1) * {_C4} end AS start_byte,
              case when cc <= 1 then null when g < n then (g - 1) * {_C4} + {_C4 - 1} else sz - 1 end AS end_byte
       from x""", "inv_x")

ORACLE["hash_chunk_plan"] = with_views(
    f""", s AS (select archiveid AS aid, size AS sz, cast((size + {_C4 - 1}) // {_C4} as integer) AS cc from inv_x),
       x AS (select aid, sz, greatest(cc, 1) AS n, unnest(generate_series(1, greatest(cc, 1))) AS g from s)
       select aid, cast(g as integer) AS part_no, (g - 1) * {_C4} AS start_byte,
              case when g < n then (g - 1) * {_C4} + {_C4 - 1} else sz - 1 end AS end_byte
       from x""", "inv_x")


def _parts_sql(name: str, unit: int, single: str) -> str:
    return f"""
       select archiveid, '{name}' AS plan,
              case when {single} then null else cast(g as integer) end AS part_no,
              case when {single} then null else (g - 1) * {unit} end AS start_byte,
              case when {single} then null when g < n then (g - 1) * {unit} + {unit - 1} else size - 1 end AS end_byte
       from (select archiveid, size, greatest((size + {unit - 1}) // {unit}, 1) AS n,
                    unnest(generate_series(1, case when {single} then 1 else greatest((size + {unit - 1}) // {unit}, 1) end)) AS g
             from inv_x) q"""


ORACLE["part_plan_2gib"] = with_views(
    _parts_sql("inventory", _C4, f"size <= {_C4}") + "\n union all \n" + _parts_sql("override", _C2, f"size < {_C2}"),
    "inv_x")

ORACLE["release_plan"] = with_views(
    f""", st AS (select archiveid AS aid, fname, size AS sz, cast((size + {_C4 - 1}) // {_C4} as integer) AS cc,
                     o.o_orderstatus AS os
                     , v.l_returnflag = 'R' AS valid
              from uniq u join orders o on u.ok = o.o_orderkey left join status_l v on v.aid = u.archiveid),
       dest AS (select distinct fname AS key from st where os = 'F'
                union select fname || '.bak' from st where os = 'O'),
       staged AS (select distinct fname AS key from st where os <> 'P'),
       pend AS (select * from st where valid and fname not in (select key from dest)),
       x AS (select aid, fname, sz, cc, greatest(cc, 1) AS n,
                    unnest(generate_series(1, case when cc <= 1 then 1 else greatest(cc, 1) end)) AS g from pend)
       select aid, x.fname, case when cc <= 1 then null else cast(g as integer) end AS part_no,
              case when cc <= 1 then null else (g - 1) * {_C4} end AS start_byte,
              case when cc <= 1 then null when g < n then (g - 1) * {_C4} + {_C4 - 1} else sz - 1 end AS end_byte,
              'staging%2F' || url_encode(x.fname) AS copy_source,
              staged.key is not null AS staged
       from x left join staged on x.fname = staged.key""", "uniq", "status_l")

VIEWS["th"] = r"""
leaves AS (
  select aid, i, n, sha256(unhex(substr(hx, i * 2048 + 1, 2048))) AS h
  from (select cast(doc_id as varchar) AS aid, hex(encode(text)) AS hx,
               greatest(cast(ceil(octet_length(encode(text)) / 1024.0) as bigint), 1) AS n
        from documents) d, generate_series(0, n - 1) g(i)
),
t AS (
  select aid, 0 AS lvl, i, n, h from leaves
  union all
  select aid, lvl + 1, i // 2, (n + 1) // 2,
         case when count(*) = 2
              then sha256(unhex(max(case when i % 2 = 0 then h end)) || unhex(max(case when i % 2 = 1 then h end)))
              else max(h) end
  from t where n > 1 group by aid, lvl, i // 2, n
),
th AS (select aid, h AS tree_hash, n0.n AS n_leaves from t join (select aid AS a2, max(n) AS n from leaves group by aid) n0 on t.aid = n0.a2 where t.n = 1)"""
_DEPS["th"] = []


def _with_recursive(body: str, *names: str) -> str:
    return with_views(body, *names).replace("WITH ", "WITH RECURSIVE ", 1)


ORACLE["tree_hash"] = _with_recursive("select aid, tree_hash from th", "th")

ORACLE["multipart_tree_hash"] = _with_recursive(
    "select aid, cast((n_leaves + 7) // 8 as integer) AS n_parts, tree_hash from th", "th")

VIEWS["routed"] = r"""
routed AS (
  select p.aid, p.sz, p.rc,
         case when th.tree_hash = (case when l.quality = 1 then th.tree_hash
                                        when l.quality = 0 then sha256('corrupt-' || p.aid) end) then 'validated'
              when p.rc < 3 then 'retry' else 'failed' end AS route
  from (select cast(doc_id as varchar) AS aid, cast(octet_length(encode(text)) as bigint) AS sz,
               cast(n_chars % 5 as integer) AS rc from documents) p
  join th on p.aid = th.aid
  left join labels l on cast(l.doc_id as varchar) = p.aid
)"""
_DEPS["routed"] = ["th"]

ORACLE["hash_validation"] = _with_recursive(
    """select aid, sz, rc, route,
              case when route = 'retry' then rc + 1 end AS next_rc,
              case when route = 'retry' then '{"Message":"{\\"Action\\":\\"RetryRequest\\",\\"ArchiveId\\":\\"' || aid
                   || '\\",\\"ArchiveSizeInBytes\\":' || cast(sz as varchar) || '}"}' end AS message
       from routed""", "routed")

ORACLE["failure_totals"] = _with_recursive(
    """select cast(coalesce(sum(sz), 0) as bigint) AS failed_bytes, count(*) AS error_count
       from routed where route = 'failed'""", "routed")

ORACLE["chunk_state"] = r"""
WITH c AS (select cast(l_orderkey as varchar) AS aid,
                  case l_returnflag when 'N' then 'copied' when 'R' then 'hashed' else 'released' end AS phase,
                  l_linenumber AS part_no,
                  concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar),
                            cast(l_partkey as varchar), cast(l_suppkey as varchar)) AS tok,
                  l_shipdate AS ship from lineitem),
v AS (select *, case when phase = 'hashed' then sha256(tok) else '"' || md5(tok) || '"' end AS value from c),
lt AS (select aid, phase, part_no, value
       from (select *, row_number() over (partition by aid, phase, part_no order by ship desc, tok desc) AS rn from v) q
       where rn = 1),
cnt AS (select cast(o_orderkey as varchar) AS aid, cast(1 + o_custkey % 7 as integer) AS cc from orders),
g AS (select aid, phase, count(*) AS n_parts,
             string_agg(cast(part_no as varchar) || ':' || value, ',' order by part_no) AS parts
      from lt group by aid, phase)
select g.aid, phase, cc, n_parts, n_parts >= cc AS complete, parts,
       array_to_string(list_transform(generate_series(1, greatest(cc, 1)), lambda x: 'chunk' || cast(x as varchar)), ', ') AS chunk_list
from g join cnt on g.aid = cnt.aid"""

ORACLE["work_gates"] = with_views(r"""
select i.archiveid AS aid,
       case when s.l_linestatus = 'F' then 'skip' else 'split' end AS split_action,
       case when s.l_returnflag in ('A', 'R') then 'hash' else 'copy' end AS copy_route,
       case when s.l_returnflag = 'R' then 'release' else 'hash' end AS hash_route
from inv_x i join status_l s on i.archiveid = s.aid""", "inv_x", "status_l")

_FMT = "'%Y-%m-%d %H:%M:%S.%f'"
ORACLE["latest_status"] = f"""
select cast(user_id as varchar) AS aid,
       strftime(min(ts) filter (where event_type = 'signup'), {_FMT}) AS cdt,
       case when arg_max(event_id, (ts, event_id)) % 11 <> 0
            then strftime(min(ts) filter (where event_type = 'click'), {_FMT}) end AS sgt,
       strftime(min(ts) filter (where event_type = 'view'), {_FMT}) AS vdt,
       strftime(min(ts) filter (where event_type = 'purchase'), {_FMT}) AS cpt,
       cast(user_id * 1000 + 1 as bigint) AS sz
from events where event_type <> 'error' group by user_id"""

_STAGE_SQL = """
select case stage when 'cdt' then 'requested' when 'sgt' then 'staged' when 'vdt' then 'validated' else 'copied' end AS stage,
       count(*) AS n, cast(sum(sz) as bigint) AS bytes
from (select distinct user_id, cast(user_id * 1000 + 1 as bigint) AS sz,
             case event_type when 'signup' then 'cdt' when 'click' then 'sgt' when 'view' then 'vdt' else 'cpt' end AS stage
      from events where event_type <> 'error') q
group by 1"""
ORACLE["stage_progress"] = _STAGE_SQL

ORACLE["progress_metrics"] = _with_recursive(
    f""", sp AS ({_STAGE_SQL}),
       tot AS (select count(*) AS c, cast(sum(size) as bigint) AS v from inv_x),
       thr AS (select cast(coalesce(sum(user_id * 1000 + 1), 0) as bigint) AS b, count(*) AS e from events where event_type = 'error'),
       fl AS (select cast(coalesce(sum(sz), 0) as bigint) AS b, count(*) AS e from routed where route = 'failed'),
       pts AS (
         select 'ArchiveCountRequested' AS metric, least((select n from sp where stage = 'requested'), (select c from tot)) AS value
         union all select 'ArchiveCountStaged', least((select n from sp where stage = 'staged'), (select c from tot))
         union all select 'ArchiveCountValidated', least((select n from sp where stage = 'validated'), (select c from tot))
         union all select 'ArchiveCountCompleted', least((select n from sp where stage = 'copied'), (select c from tot))
         union all select 'BytesRequested', least((select bytes from sp where stage = 'requested'), (select v from tot))
         union all select 'BytesStaged', least((select bytes from sp where stage = 'staged'), (select v from tot))
         union all select 'BytesValidated', least((select bytes from sp where stage = 'validated'), (select v from tot))
         union all select 'BytesCompleted', least((select bytes from sp where stage = 'copied'), (select v from tot))
         union all select 'ArchiveCountTotal', (select c from tot)
         union all select 'BytesTotal', (select v from tot)
         union all select 'ThrottledBytes', (select b from thr)
         union all select 'ThrottledErrorCount', (select e from thr)
         union all select 'FailedArchivesBytes', (select b from fl)
         union all select 'FailedArchivesErrorCount', (select e from fl))
       select metric, 'vaultlens' AS dimension, 'None' AS unit, cast(value as bigint) AS value from pts""", "routed", "inv_x")

ORACLE["scheduled_snapshot"] = (
    ORACLE["progress_metrics"][:ORACLE["progress_metrics"].index("select metric, 'vaultlens'")]
    + "select metric, 'vaultlens' AS dimension, 'None' AS unit, cast(tick as bigint) AS tick, "
      "cast(case when tick = 0 and metric not like '%Total' then 0 else value end as bigint) AS value "
      "from pts, (select unnest([0, 1, 2]) AS tick) "
      "where metric not like 'Throttled%' and metric not like 'Failed%'")

ORACLE["counter_item"] = with_views(
    f""", sp AS ({_STAGE_SQL})
       select 'count' AS pk, cast(max(n) filter (where stage = 'requested') as bigint) AS requested,
              cast(max(n) filter (where stage = 'staged') as bigint) AS staged,
              cast(max(n) filter (where stage = 'validated') as bigint) AS validated,
              cast(max(n) filter (where stage = 'copied') as bigint) AS copied,
              (select count(*) from inv_x) AS total from sp""", "inv_x")

ORACLE["metric_timeline"] = """
select strftime(time_bucket(interval '5 minutes', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       event_type AS metric, max(value) AS max_value
from events group by 1, 2"""

ORACLE["latest_metric_values"] = """
select metric, value from (
  select event_type AS metric, value, row_number() over (partition by event_type order by ts desc, event_id desc) AS rn
  from events) q where rn = 1"""

ORACLE["oldest_message_age"] = """
WITH m0 AS (select event_type AS queue, epoch_us(ts) AS s,
                   case when event_id % 97 <> 0 then epoch_us(ts) + cast(round(value * 60000000) as bigint) end AS d from events),
m AS (select queue, s, coalesce(d, (select max(greatest(s, coalesce(d, s))) from m0)) AS d from m0),
k AS (select queue, s, unnest(generate_series(cast(ceil(s / 300000000.0) as bigint), cast(ceil(d / 300000000.0) as bigint) - 1)) AS k from m)
select queue, k * 300000000 AS at_us, k * 300000000 - min(s) AS age_us from k group by queue, k"""

ORACLE["error_log"] = f"""
select event_id, strftime(ts, {_FMT}) AS ts, message from (
  select event_id, ts,
         (case when event_type = 'error' then
               (case event_id % 4 when 0 then 'error' when 1 then 'Error' when 2 then 'ERROR' else 'eRRor' end) || ': '
               else 'INFO ' end)
         || event_type || ' ' || props
         || (case when value > 45 then ' ThrottlingException' when value < 5 then ' Idle connections will be closed' else '' end) AS message
  from events) q
where (message like '%error%' or message like '%Error%' or message like '%ERROR%')
  and message not like '%ThrottlingException%' and message not like '%Idle connections will be closed%'"""

ORACLE["cleanup_batches"] = """
WITH k AS (select page_id % 5 AS listing,
                  ['results', 'partitioned', 'inventory', 'filelist', 'glue'][page_id % 5 + 1] || '/' ||
                  regexp_replace(url, '^[a-z]+://', '') AS key from pages),
r AS (select *, row_number() over (order by listing, key) AS rn from k)
select cast(rn // 1000 as bigint) AS batch, count(*) AS n_keys, arg_min(key, rn) AS first_key, arg_max(key, rn) AS last_key
from r group by 1"""

ORACLE["location_split"] = """
select page_id, loc,
       case when strpos(loc, '/') > 0 then split_part(loc, '/', 1) end AS bucket,
       case when strpos(loc, '/') > 0 then substr(loc, strpos(loc, '/') + 1) else loc end AS key,
       regexp_replace(loc, '^.*/', '') AS file_name
from (select page_id, regexp_replace(url, '^[a-z]+://', '') AS loc from pages) q"""

ORACLE["partition_roundtrip"] = with_views(
    """select distinct cast(row_num as bigint) AS row_num, archiveid, size, sha256treehash, creationdate,
              archivedescription, cast(part as bigint) AS part from parted""", "parted")

ORACLE["one_partition"] = with_views(
    """select distinct cast(row_num as bigint) AS row_num, archiveid, size, sha256treehash, creationdate, archivedescription
       from parted where part = (select max(part) from parted)""", "parted")

ORACLE["max_partition"] = with_views(
    """select cast(max(part) as bigint) AS max_part,
              '{"nextPartition":0,"maxPartition":' || cast(max(part) as varchar) || '}' AS payload from parted""", "parted")

ORACLE["consistency_check"] = with_views(
    """select count(*) AS archive_count, coalesce(cast(sum(size) as bigint), 0) AS vault_bytes,
              count(*) AS partitioned_count, 'READY' AS state from inv_x""", "inv_x")

ORACLE["csv_sources"] = with_views(
    """select archiveid, archivedescription, creationdate, size, sha256treehash from parted""", "parted")

ORACLE["notice_parse"] = with_views(
    """select 'retrieval' AS shape, archiveid AS archive_id, 'job-' || archiveid AS job_id, size from inv_x
       union all
       select 'inventory', null, 'inventory-job', coalesce(cast(sum(size) as bigint), 0) from inv_x""", "inv_x")

ORACLE["range_io"] = """
WITH d AS (select cast(doc_id as varchar) AS aid, hex(encode(text)) AS hx, octet_length(encode(text)) AS n from documents),
p AS (select aid, hx, n, unnest(generate_series(1, greatest((n + 4095) // 4096, 1))) AS g from d)
select aid, cast(g as integer) AS part_no, cast(least(4096, n - (g - 1) * 4096) as bigint) AS nbytes,
       '"' || md5(unhex(substr(hx, (g - 1) * 8192 + 1, 8192))) || '"' AS etag
from p"""

ORACLE["stream_stage_progress"] = _STAGE_SQL
ORACLE["stream_first_transition"] = _STAGE_SQL
ORACLE["stream_chunk_completion"] = (
    ORACLE["chunk_state"][:ORACLE["chunk_state"].index("select g.aid, phase, cc, n_parts")]
    + "select g.aid, phase, cc from g join cnt on g.aid = cnt.aid where n_parts >= cc")
ORACLE["stream_metric_window"] = ORACLE["metric_timeline"]
ORACLE["stream_chunk_plan"] = with_views(f"""
, s AS (select *, 0 AS rc from status_l where l_linestatus <> 'F'
        union all select *, 1 from status_l where l_linestatus <> 'F' and l_returnflag in ('A', 'R')),
c AS (select aid, rc, sz, cast((sz + {_C4 - 1}) // {_C4} as integer) AS cc from s),
x AS (select aid, rc, sz, cc, greatest(cc, 1) AS n,
             unnest(generate_series(1, case when cc <= 1 then 1 else greatest(cc, 1) end)) AS g from c)
select aid, 'obj/' || aid AS fname, 'job-' || aid AS job_id, cast(rc as integer) AS rc,
       case when cc <= 1 then null else cast(g as integer) end AS part_no,
       case when cc <= 1 then null else (g - 1) * {_C4} end AS start_byte,
       case when cc <= 1 then null when g < n then (g - 1) * {_C4} + {_C4 - 1} else sz - 1 end AS end_byte
from x""", "status_l")
ORACLE["stream_hash_validation"] = _with_recursive("select aid, sz, rc, route from routed", "routed")

ORACLE["stream_status_upsert"] = ORACLE["latest_status"]
# Batch numbers from 0; -1: different records in all batches, -2: removals among them.
ORACLE["stream_admitted_batches"] = """
WITH n AS (select count(*) AS n from events)
select cast(b as bigint) AS batch, cast(least(5000, n - 5000 * b) as bigint) AS records
from n, (select unnest(generate_series(0, 10000000)) AS b) where 5000 * b < n
union all select -1, count(distinct event_id) from events
union all select -2, count(*) from events where event_type = 'error'"""

# Per field the latest write after the record's last removal; a written null clears the field.
ORACLE["stream_field_upsert"] = f"""
WITH e AS (select cast(user_id as varchar) AS aid, user_id, (epoch_us(ts), event_id) AS seq, ts, event_id, event_type AS k,
                  event_type = 'error' and event_id % 3 = 0 AS removed from events),
r AS (select aid, max(seq) filter (where removed) AS gone from e group by aid),
w AS (select e.* from e join r on e.aid = r.aid where not removed and (gone is null or seq > gone))
select aid, strftime(max_by(ts, seq) filter (where k = 'signup'), {_FMT}) AS cdt,
       strftime((max_by({{'t': case when k = 'click' and event_id % 11 <> 0 then ts end}}, seq)
                 filter (where k in ('click', 'error'))).t, {_FMT}) AS sgt,
       strftime(max_by(ts, seq) filter (where k = 'view'), {_FMT}) AS vdt,
       strftime(max_by(ts, seq) filter (where k = 'purchase'), {_FMT}) AS cpt,
       cast(max_by(user_id * 1000 + event_id, seq) filter (where k = 'signup') as bigint) AS sz
from w group by aid"""
ORACLE["latest_fields"] = f"""
WITH w AS (select cast(user_id as varchar) AS aid, user_id, (epoch_us(ts), event_id) AS seq, ts, event_id, event_type AS k
           from events where event_type <> 'error' or event_id % 3 <> 0)
select aid, strftime(max_by(ts, seq) filter (where k = 'signup'), {_FMT}) AS cdt,
       strftime((max_by({{'t': case when k = 'click' and event_id % 11 <> 0 then ts end}}, seq)
                 filter (where k in ('click', 'error'))).t, {_FMT}) AS sgt,
       strftime(max_by(ts, seq) filter (where k = 'view'), {_FMT}) AS vdt,
       strftime(max_by(ts, seq) filter (where k = 'purchase'), {_FMT}) AS cpt,
       cast(max_by(user_id * 1000 + event_id, seq) filter (where k = 'signup') as bigint) AS sz
from w group by aid"""

ORACLE["raw_chunks"] = """
WITH c AS (select cast(l_orderkey as varchar) AS aid, cast(l_linenumber as integer) AS part_no, l_returnflag AS f, l_shipdate AS d,
                  concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar), cast(l_partkey as varchar),
                            cast(l_suppkey as varchar)) AS tok from lineitem),
m AS (select aid, part_no, max_by(case when f = 'R' then sha256(tok) else '"' || md5(tok) || '"' end, (d, tok)) AS value
      from c group by aid, part_no)
select aid, part_no, value, case when length(value) > 40 then 'hashed' else 'etag' end AS kind from m"""
ORACLE["staged_tree_hash"] = ORACLE["tree_hash"]
ORACLE["results_csv"] = with_views(
    """select distinct cast(row_num as bigint) AS row_num, archiveid, size, sha256treehash, creationdate,
              archivedescription from parted""", "parted")
ORACLE["object_listing"] = """
WITH d AS (select doc_id % 2 AS listing, cast(doc_id as varchar) AS k, octet_length(encode(text)) AS n from documents),
r AS (select listing, n, row_number() over (order by listing, k) AS rn from d)
select cast(listing as integer) AS listing, cast(rn // 1000 as bigint) AS batch, count(*) AS n_keys,
       cast(sum(n) as bigint) AS bytes
from r group by 1, 2"""

ORACLE["request_rows"] = with_views(
    """, rec AS (select i.archiveid from inv_x i join orders o on i.ok = o.o_orderkey where o.o_orderstatus = 'F'),
       done AS (select *, row_number() over (partition by fname0 order by row_num) AS k
                from named where archiveid in (select archiveid from rec)),
       dsfx AS (select fname0 || '-' || creationdate AS sname, min(row_num) AS srow from done where k > 1 group by 1),
       recn AS (select distinct case when k > 1 or coalesce(srow < row_num, false)
                                     then fname0 || '-' || creationdate else fname0 end AS rname
                from done left join dsfx on k = 1 and sname = fname0),
       lastp AS (select part, max(row_num) AS max_ifn from done group by part),
       todo AS (select n.*, row_number() over (partition by n.fname0 order by n.row_num) AS k,
                       n.fname0 in (select rname from recn) AS taken
                from named n left join lastp l on n.part = l.part where n.row_num > coalesce(l.max_ifn, 0)),
       tsfx AS (select fname0 || '-' || creationdate AS sname, min(row_num) AS srow from todo where k > 1 or taken group by 1)
       select archiveid AS aid, cast(row_num as bigint) AS ifn, cast(part as bigint) AS pid,
              case when k > 1 or taken or coalesce(srow < row_num, false)
                   then fname0 || '-' || creationdate else fname0 end AS fname,
              cast((size + 4294967295) // 4294967296 as integer) AS cc
       from todo left join tsfx on k = 1 and sname = fname0""", "named")
