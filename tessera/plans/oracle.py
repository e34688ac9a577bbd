"""DuckDB SQL for each registered job, run on the same Parquet tables.

Written independently of the Spark code paths (plain SQL statements of each
job's meaning), and aliased to the Spark output column names. Orderings
state ``nulls first`` where Spark's ascending default does. DuckDB's
``lower`` maps code point by code point, while Spark (like the JVM) lowers a
word-final capital sigma to the final form; the test texts have none.
"""

from __future__ import annotations

_WORDS = r"""
select lower(w) as word
from (select unnest(regexp_extract_all(text, '[\p{L}''-]+')) as w from documents)
"""

_WORD_COUNT = f"select word, count(*) as cnt from ({_WORDS}) group by word"

ORACLE: dict[str, str] = {
    "line_count": """
        select sum(len(string_split(text, chr(10)))
                   - case when text = '' or suffix(text, chr(10)) then 1 else 0 end)::bigint as n_lines
        from documents
    """,
    "dated_line_count": """
        select count(*) as n_lines from events
        where cast(ts as date) >= (select max(cast(ts as date)) from events) - 14
    """,
    "word_count": _WORD_COUNT,
    "word_count_topk": f"""
        select row_number() over (order by cnt desc, word desc) as rnk, word, cnt
        from ({_WORD_COUNT}) order by cnt desc, word desc limit 1000
    """,
    "value_share": """
        select v as event_type,
               (select count(*) from events where event_type = v)::double
                 / (select count(*) from events) as share
        from (values ('error'), ('click'), ('none')) t(v)
    """,
    "affected_share": """
        with a as (select count(distinct c_name) as n from customer
                   where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')),
             t as (select count(distinct c_name) as n from customer)
        select a.n as n_affected, t.n as n_total, a.n::double / t.n as share from a, t
    """,
    "topk_share": """
        select p_type, cnt, cnt::double / (select count(*) from part) as share
        from (select p_type, count(*) as cnt from part group by p_type)
        order by cnt desc, p_type nulls first limit 5
    """,
    "anagram_groups": r"""
        select string_agg(w, ' ' order by w) as words
        from (select distinct unnest(string_split_regex(text, '[ \n]')) as w from documents)
        group by array_to_string(list_sort(string_split(w, '')), '')
        having count(*) > 1
    """,
    "pair_digest_match": """
        select c_name, c_mktsegment, md5(c_name || ':' || c_mktsegment) as digest
        from customer
        where md5(c_name || ':' || c_mktsegment) in
              (select md5(c_name || ':' || 'AUTOMOBILE') from customer)
    """,
    "option_expand": """
        select c_name as region, c_name || '-' || s as zone
        from customer, (values ('a'), ('b'), ('c'), ('e')) v(s)
        where c_name is not null
    """,
    "trailing_topn_avg": """
        with a as (select date_trunc('second', max(ts) - interval 12 hour) as lo from events),
             r as (select event_type, value,
                          row_number() over (partition by event_type order by value desc) as rn
                   from events, a where ts >= lo)
        select event_type, round(avg(value), 6) as avg_top from r where rn <= 10 group by event_type
    """,
    "cheapest_under_limit": """
        with m as (select max(ts) as now from events),
        w as (select date_trunc('second', now - interval 12 hour) as lo12,
                     date_trunc('second', now - interval 6 hour) as lo6 from m),
        h as (select event_type, user_id, value,
                     row_number() over (partition by event_type, user_id order by value desc) as rn
              from events, w where ts >= lo12),
        r as (select event_type, user_id, value,
                     row_number() over (partition by event_type, user_id order by value desc) as rn
              from events, w where ts >= lo6),
        hp as (select event_type, user_id, avg(value) as hist from h where rn <= 10 group by 1, 2),
        rp as (select event_type, user_id, avg(value) as rec from r where rn <= 2 group by 1, 2),
        p as (select hp.event_type, hp.user_id,
                     greatest(coalesce(rp.rec, 0), coalesce(hp.hist, 0)) as price
              from hp left join rp on hp.event_type is not distinct from rp.event_type
                                  and hp.user_id is not distinct from rp.user_id),
        l as (select * from (values (1, 'view', 20.0), (2, 'click', 60.0), (3, 'error', 500.0))
                     t(pos, event_type, max_price)),
        b as (select p.*, l.pos, l.max_price,
                     row_number() over (partition by l.pos, p.event_type
                                        order by price, user_id nulls first) as k
              from p join l on p.event_type = l.event_type where price > 0)
        select pos, event_type, user_id, round(price, 6) as price
        from b where k = 1 and price < max_price * 0.8
        order by pos limit 1
    """,
    "choice_severity": """
        with k as (select event_type, pos, 5 as n
                   from (values (1::bigint, 'click'), (2, 'error'), (3, 'purchase'), (4, 'signup'), (5, 'view'))
                        t(pos, event_type)
                   where event_type in (select event_type from events))
        select event_type, pos,
               case when pos = 1 then null
                    when pos = n then 'CRITICAL'
                    when pos - 1 >= n // 2 then 'CRITICAL'
                    else 'WARNING' end as severity
        from k
    """,
    "ttl_exclude": """
        select v.event_id, v.user_id from events v
        where v.event_type = 'view' and not exists (
            select 1 from events e
            where e.event_type = 'error' and e.user_id = v.user_id
              and e.ts <= v.ts and e.ts > v.ts - interval 3 hour)
    """,
    "failure_streak": """
        with e as (select event_id, case when event_id % 7 <> 0 then user_id end as user_id, ts, event_type
                   from events),
             s as (select event_id, user_id, ts, event_type,
                          sum(case when event_type <> 'error' then 1 else 0 end)
                            over (partition by user_id order by ts nulls first, event_id nulls first
                                  rows between unbounded preceding and current row) as g
                   from e),
             r as (select event_id, user_id, event_type,
                          sum(case when event_type = 'error' then 1 else 0 end)
                            over (partition by user_id, g order by ts nulls first, event_id nulls first
                                  rows between unbounded preceding and current row) as run
                   from s)
        select event_id, user_id, ((run - 1) % 2 + 1)::bigint as streak from r where event_type = 'error'
    """,
    "word_count_stream": _WORD_COUNT,
    "anagram_members": r"""
        with t as (select distinct unnest(string_split_regex(text, '[ \n]')) as word from documents),
             k as (select array_to_string(list_sort(string_split(word, '')), '') as anagram_key, word from t)
        select anagram_key, word from k
        where anagram_key in (select anagram_key from k group by 1 having count(*) > 1)
    """,
    "cheapest_without_limit": """
        with m as (select max(ts) as now from events),
        gone as (select distinct user_id from events, m
                 where event_type = 'error' and ts <= now and now < ts + interval 3 hour),
        first_free as (select min(c_custkey) as user_id from customer
                       where c_mktsegment = 'HOUSEHOLD' and c_custkey not in (select user_id from gone where user_id is not null))
        select 3 as pos, 'HOUSEHOLD' as event_type, user_id, cast(null as double) as price, 'CRITICAL' as severity
        from first_free where user_id is not null
    """,
    "failure_streak_health": """
        with recursive e as (
          select event_id, case when event_id % 7 <> 0 then user_id end as user_id, ts,
                 event_type in ('error', 'click') as failed, event_id % 3 <> 0 as ok from events),
        o as (select *, row_number() over (partition by user_id order by ts nulls first, event_id) as n from e),
        w as (select event_id, user_id, n, failed, case when failed then 1 else 0 end as streak,
                     case when failed then 1 else 0 end as state
              from o where n = 1
              union all
              select o.event_id, o.user_id, o.n, o.failed, case when o.failed then w.state + 1 else 0 end,
                     case when not o.failed or (o.ok and w.state + 1 >= 2) then 0 else w.state + 1 end
              from w join o on o.user_id is not distinct from w.user_id and o.n = w.n + 1)
        select event_id, user_id, streak::bigint as streak from w where failed
    """,
    "status_share": """
        select s as status, (select count(*) from orders where o_orderstatus = s)::double
                            / (select count(*) from orders) as share
        from (values ('F'), ('O'), ('P'), ('X')) t(s)
    """,
    "affected_ip_share": """
        with a as (select count(distinct c_name) as n from customer
                   where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')),
             t as (select count(distinct c_name) as n from customer)
        select a.n as n_affected, t.n as n_total, a.n::double / t.n as share from a, t
    """,
    "top_pages_share": """
        select '/page' || (o_orderkey % 97) as page, count(*) as cnt,
               count(*)::double / (select count(*) from orders) as share
        from orders group by 1 order by cnt desc, page limit 5
    """,
    "top_pages_lines": """
        select page || ' ' || cnt || ' ' || cast(floor(cnt::double / total * 100) as bigint) as line
        from (select '/page' || (o_orderkey % 97) as page, count(*) as cnt,
                     (select count(*) from orders) as total
              from orders group by 1 order by cnt desc, page limit 5)
    """,
    "printed_top_words": f"""
        select row_number() over (order by cnt desc, word desc) || ') ' || cnt || ' - ' || chr(39) || word || chr(39)
               as line
        from ({_WORD_COUNT}) order by cnt desc, word desc limit 1000
    """,
    "completed_line_count": "select count(*) as n_lines from orders where o_orderstatus is distinct from 'P'",
    "word_rank": f"""
        select row_number() over (order by cnt desc, word desc) as rnk, word, cnt from ({_WORD_COUNT})
    """,
    "key_rank": """
        select row_number() over (order by cnt desc, page) as rnk, page, cnt,
               cnt::double / (select count(*) from orders) as share
        from (select '/page' || (o_orderkey % 97) as page, count(*) as cnt from orders group by 1)
    """,
    "trailing_topn_series": """
        with w as (select a.event_id, a.event_type, b.value,
                          row_number() over (partition by a.event_id order by b.value desc) as rn
                   from events a join events b on b.event_type = a.event_type
                    and b.ts >= date_trunc('second', a.ts - interval 12 hour)
                    and (b.ts < a.ts or (b.ts = a.ts and b.event_id <= a.event_id)))
        select event_id, event_type, round(avg(value), 6) as avg_top from w where rn <= 10 group by 1, 2
    """,
    "choices_over_time": """
        with l as (select * from (values (1, 'view', 20.0), (2, 'click', 60.0), (3, 'error', 500.0))
                   t(pos, event_type, max_price)),
        q as (select event_id as id, ts as t from events where event_type = 'signup'),
        w as (select id, t, e.event_type, user_id, value, ts >= date_trunc('second', t - interval 6 hour) as recent,
                     row_number() over (partition by id, e.event_type, user_id order by value desc) as hr,
                     row_number() over (partition by id, e.event_type, user_id,
                                        ts >= date_trunc('second', t - interval 6 hour) order by value desc) as rr
              from q join events e on e.ts <= q.t and e.ts >= date_trunc('second', q.t - interval 12 hour)
              join l on l.event_type = e.event_type
              where not exists (select 1 from events x where x.event_type = 'error' and x.user_id = e.user_id
                                and x.ts <= q.t and q.t < x.ts + interval 3 hour)),
        p as (select id, event_type, user_id,
                     greatest(coalesce(avg(value) filter (hr <= 10), 0), coalesce(avg(value) filter (recent and rr <= 2), 0))
                       as price from w group by 1, 2, 3),
        b as (select id, pos, p.event_type, user_id, price, max_price,
                     row_number() over (partition by id, pos order by price, user_id nulls first) as k
              from p join l on l.event_type = p.event_type where price > 0),
        c as (select *, row_number() over (partition by id order by pos) as k2 from b where k = 1 and price < max_price * 0.8)
        select q.id as event_id, c.pos, c.event_type, c.user_id, round(c.price, 6) as price
        from q left join c on c.id = q.id and c.k2 = 1
    """,
    "incremental_line_count": "select cast(ts as date) as day, count(*) as n_lines from events group by 1",
    "affected_by_range": """
        with b as (select year(min(o_orderdate)) as y0, year(max(o_orderdate)) as y1 from orders),
        q as (select make_date(y, 3 * k + 1, 1) as date_from,
                     cast(make_date(y, 3 * k + 1, 1) + interval 3 month - interval 1 day as date) as date_to
              from b, range(y0, y1 + 1) t(y), range(4) u(k)),
        r as (select * from q union all
              select (select min(date_from) from q), date_to from q where date_to > (select min(date_to) from q))
        select date_from, date_to, count(distinct c_name) filter (o_orderstatus = 'P') as n_affected,
               count(distinct c_name) as n_total,
               case when count(distinct c_name) > 0 then count(distinct c_name) filter (o_orderstatus = 'P')::double
                    / count(distinct c_name) end as share
        from r left join (orders join customer on c_custkey = o_custkey)
          on cast(o_orderdate as date) between date_from and date_to
        group by 1, 2
    """,
}
# the streams give what the batch jobs give
ORACLE["ttl_exclude_stream"] = ORACLE["ttl_exclude"]
ORACLE["failure_streak_stream"] = ORACLE["failure_streak_health"]
ORACLE["word_topk_stream"] = ORACLE["word_count_topk"]
