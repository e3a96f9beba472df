"""DuckDB SQL for the registered queries, over the same whole tables."""

from __future__ import annotations

# Common table expressions and what each builds on.
PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, *needs: str):
    def add(sql: str) -> None:
        PARTS[name] = (needs, sql)
    return add


part("event_posts")("""
    select cast(e.event_id as varchar) as id,
           concat(case when e.event_type = 'view' then upper(p1.p_name) else p1.p_name end,
                  ' ', p2.p_name, ' ', p3.p_name) as title,
           concat('/r/', e.event_type, '/comments/', e.event_id) as permalink,
           concat('http://ex.org/', e.event_type, '/', e.event_id * 7919) as url,
           concat('User', e.user_id) as author,
           e.event_type as subreddit,
           e.ts as created_utc,
           e.value >= 150 as over_18,
           cast(floor(e.value) as bigint) as ups,
           case when e.event_type <> 'click' then length(e.props) end as gilded,
           (e.event_id * 7919 + 13) % (1 + cast(floor(e.value) as bigint)) as given
    from events e
    join part p1 on p1.p_partkey = e.event_id % (select count(*) from part)
    join part p2 on p2.p_partkey = e.event_id * 7 % (select count(*) from part)
    join part p3 on p3.p_partkey = e.event_id * 13 % (select count(*) from part)
""")

part("event_messages", "event_posts")("""
    select id, lower(title) as title, lower(permalink) as permalink, lower(url) as url,
           lower(author) as author, lower(subreddit) as subreddit, created_utc, over_18, ups,
           cast('0x' || substr(md5(id), 1, 15) as bigint) % (ups + 1) as downs,
           cast(gilded as bigint) as gilded, ups - given as score
    from event_posts
    where ups > 0
""")

part("document_posts")("""
    select cast(d.doc_id as varchar) as id, d.text as title,
           concat('/r/', d.source, '/comments/', d.doc_id) as permalink,
           pg.url as url, concat('User', e.user_id) as author, d.source as subreddit,
           e.ts as created_utc, l.toxic = 1 as over_18,
           cast(floor(e.value) as bigint) as ups, length(e.props) as gilded
    from documents d
    join events e on e.event_id = d.doc_id
    join pages pg on pg.page_id = d.doc_id % (select count(*) from pages)
    left join labels l on l.doc_id = d.doc_id
""")

part("part_registry")("""
    select distinct p_name as query from part
    union
    select unnest(string_split(p_name, ' ')) from part
""")

part("part_phrases", "part_registry")(r"""
    select query, array_to_string(regexp_extract_all(lower(query), '[\p{L}\p{N}_]+'), ' ') as phrase
    from part_registry
""")

part("word_topics", "part_registry")("""
    select query from part_registry where not contains(query, ' ')
""")

part("benchmark_phrases")(r"""
    select query, array_to_string(regexp_extract_all(lower(query), '[\p{L}\p{N}_]+'), ' ') as phrase
    from (select text as query from benchmark
          union
          select unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) from benchmark)
""")

part("event_matches", "event_messages", "part_phrases")(r"""
    select m.*, p.query
    from (select *, array_to_string(regexp_extract_all(title, '[\p{L}\p{N}_]+'), ' ') as words
          from event_messages) m
    join part_phrases p
      on p.phrase <> '' and contains(concat(' ', m.words, ' '), concat(' ', p.phrase, ' '))
""")

part("document_matches", "benchmark_phrases")(r"""
    select d.doc_id, p.query
    from (select doc_id,
                 array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), ' ') as words
          from documents) d
    join benchmark_phrases p
      on p.phrase <> '' and contains(concat(' ', d.words, ' '), concat(' ', p.phrase, ' '))
""")

part("posts", "event_messages", "part_phrases")(r"""
    select query, created_utc, id as doc_id, subreddit, title, permalink, url, author, ups, downs
    from (select m.*, p.query, row_number() over (partition by m.id order by p.query) as nth
          from (select *, array_to_string(regexp_extract_all(title, '[\p{L}\p{N}_]+'), ' ') as words
                from event_messages where over_18 = false) m
          join part_phrases p
            on p.phrase <> '' and contains(concat(' ', m.words, ' '), concat(' ', p.phrase, ' ')))
    where nth <= 5
""")

part("minute_posts", "posts")("""
    select * replace (date_trunc('minute', created_utc) as created_utc) from posts
""")

part("votes", "minute_posts")("""
    select query, cast(date_trunc('hour', created_utc) as timestamp) as time_utc,
           cast(sum(ups) as bigint) as ups, cast(sum(downs) as bigint) as downs
    from minute_posts
    group by all
""")

part("series", "votes")("""
    select query, epoch_ms(time_utc) as ts_ms, ups, ups + downs as total from votes
""")

part("cursors", "posts", "part_registry")("""
    select r.query, case when not contains(r.query, ' ') then c.lasttime end as lasttime
    from part_registry r
    left join (select query, max(created_utc) as lasttime from posts
               where subreddit = 'signup' group by query) c on c.query = r.query
""")

part("per_second", "posts")("""
    select query, cast(floor(epoch(created_utc)) as bigint) as sec, count(*) as n
    from posts group by all
""")

part("ranked", "posts")("""
    select *, row_number() over (partition by query order by created_utc desc, doc_id) as rank
    from posts
""")

part("polled", "posts", "ranked", "cursors")("""
    select p.* from posts p join cursors c on c.query = p.query and p.created_utc > c.lasttime
    union all
    select p.* exclude (rank) from ranked p join cursors c on c.query = p.query
    where c.lasttime is null and p.rank <= 2
""")

part("upserted", "posts")("""
    select * replace (case when subreddit = 'signup' then ups * 2 else ups end as ups) from posts
""")


def top10(source: str) -> str:
    return f"""
        select *, row_number() over (order by created_utc desc, doc_id) as rank
        from (select * exclude (nth)
              from (select *, row_number() over (partition by doc_id order by query) as nth
                    from ({source}))
              where nth = 1)
        qualify rank <= 10
    """


WORD_POSTS = "select * from posts where query in (select query from word_topics)"

SLIDES = """
    select query, unnest(generate_series(
               date_trunc('minute', created_utc) + interval 1 minute,
               date_trunc('minute', created_utc) + interval 5 minute,
               interval 1 minute)) as until_utc
    from posts
"""


def _with(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for inner in PARTS[name][0]:
                visit(inner)
            order.append(name)

    for name in needs:
        visit(name)
    ctes = ",\n".join(f"{name} as materialized ({PARTS[name][1]})" for name in order)
    return f"with {ctes}\n{body}" if ctes else body


POSTS_ROUND = "select * from posts"

SQL: dict[str, str] = {
    "ingest_messages": _with("select * from event_messages", "event_messages"),
    "derive_downs": _with("select id, ups, downs from event_messages", "event_messages"),
    "rejected_lines": """
        select 'not a JSON object' as reason, count(*) as n from documents
        union all
        select case event_type when 'click' then 'not a time: created_utc'
                    when 'signup' then 'up-votes missing or negative'
                    else 'not a whole number: score' end as reason, count(*)
        from events where event_type in ('click', 'signup', 'purchase') and floor(value) > 0
        group by reason
    """,
    "rejected_values": """
        select case event_type when 'click' then 'not a time: created_utc'
                    when 'signup' then 'up-votes missing or negative'
                    when 'purchase' then 'not a whole number: score'
                    else 'accepted' end as reason, count(*) as n
        from events where floor(value) > 0 group by reason
    """,
    "nested_line_files": """
        select case when floor(value) = 0 then 11 else 12 end::bigint as keys, count(*) as n
        from events group by all
    """,
    "dedup_messages": _with("""
        select id,
               case when subreddit = 'click' then least(title, reverse(title)) else title end as title,
               ups, created_utc
        from event_messages
    """, "event_messages"),
    "safe_posts": _with("select id, title from document_posts where over_18 = false",
                        "document_posts"),
    "topic_round_trip": _with("select * from event_messages", "event_messages"),
    "line_files": """
        select case when floor(value) = 0 then 11 else 12 end::bigint as keys, count(*) as n
        from events group by all
    """,
    "percolate_matches": _with("select id, query from event_matches", "event_matches"),
    "percolate_shuffled": _with("select id, query from event_matches", "event_matches"),
    "percolate_documents": _with("select doc_id, query from document_matches", "document_matches"),
    "percolate_documents_shuffled": _with("select doc_id, query from document_matches",
                                          "document_matches"),
    "percolate_any": _with("select distinct doc_id from document_matches", "document_matches"),
    "percolate_counts": _with("""
        select doc_id, count(*) as match_total, least(count(*), 5) as capped
        from document_matches group by doc_id
    """, "document_matches"),
    "percolate_top5": _with("""
        select id, query, row_number() over (partition by id order by query) as rank
        from event_matches qualify rank <= 5
    """, "event_matches"),
    "percolate_nested": _with("""
        select id, query, least(count(*) over (partition by id), 5) as total
        from event_matches qualify row_number() over (partition by id order by query) <= 5
    """, "event_matches"),
    "posts_table": _with(POSTS_ROUND, "posts"),
    "posts_table_documents": _with("""
        select query, created_utc, id as doc_id, subreddit, title, permalink, url, author, ups, downs
        from (select m.query, d.created_utc, d.id, d.subreddit, d.title, d.permalink, d.url,
                     d.author, d.ups, 0::bigint as downs,
                     row_number() over (partition by m.doc_id order by m.query) as nth
              from document_matches m
              join document_posts d on d.id = cast(m.doc_id as varchar)
              where coalesce(d.over_18, false) = false)
        where nth <= 5
    """, "document_matches", "document_posts"),
    "hourly_votes": _with("select * from votes where query in (select query from word_topics)",
                          "votes", "word_topics"),
    "hourly_votes_open": _with("""
        select query, cast(date_trunc('hour', created_utc) as timestamp) as time_utc,
               cast(sum(ups) as bigint) as ups, cast(sum(downs) as bigint) as downs
        from minute_posts
        where created_utc <> date_trunc('hour', created_utc)
        group by all
    """, "minute_posts"),
    "scan_posts": _with(f"select query, doc_id, ups, downs from ({WORD_POSTS})",
                        "posts", "word_topics"),
    "series_votes": _with("select * from series", "series"),
    "series_arrays": _with("""
        select t.query, count(s.ts_ms) as n,
               coalesce(string_agg(s.ts_ms || ':' || s.total, ',' order by s.ts_ms), '') as data
        from (select query from word_topics union all select upper(query) from word_topics) t
        left join series s on s.query = t.query
        group by t.query
    """, "series", "word_topics"),
    "series_percent": _with("""
        select query, ts_ms, pct,
               concat(case when shown > 0 then ' + ' else '' end,
                      regexp_replace(cast(shown as varchar), '[.]0$', ''), '%') as label
        from (select *, cast(pct as decimal(20, 1)) as shown
              from (select query, ts_ms,
                           100.0::double * ups / nullif(first_value(
                               case when ups <> 0 then ups end ignore nulls) over (
                               partition by query order by ts_ms
                               rows between unbounded preceding and unbounded following), 0)
                           - 100.0::double as pct
                    from (select *, max(ts_ms) over (partition by query) as newest from series)
                    where ts_ms >= newest - 14 * 86400000::bigint))
    """, "series"),
    "trailing_5min": _with("""
        select a.query, make_timestamp(a.sec * 1000000) as until_utc, cast(sum(b.n) as bigint) as n
        from per_second a
        join per_second b on b.query = a.query and b.sec between a.sec - 300 and a.sec
        group by a.query, a.sec
    """, "per_second"),
    "count_at_cursor": _with("""
        select c.query, c.lasttime, count(*) as n
        from cursors c
        join posts p on p.query = c.query
         and floor(epoch(p.created_utc)) between floor(epoch(c.lasttime)) - 300
                                             and floor(epoch(c.lasttime))
        group by c.query, c.lasttime
    """, "cursors", "posts"),
    "sliding_5min": _with(f"select query, until_utc, count(*) as n from ({SLIDES}) group by all", "posts"),
    "paned_5min": _with(f"select query, until_utc, count(*) as n from ({SLIDES}) group by all", "posts"),
    "series_grains": _with("""
        select query, grain, cast(date_trunc(grain, time_utc) as timestamp) as time_utc,
               cast(sum(ups) as bigint) as ups, cast(sum(downs) as bigint) as downs
        from votes, (values ('hour'), ('day'), ('month')) as g(grain)
        group by all
    """, "votes"),
    "series_drawn": _with("""
        select query, epoch_ms(day) as ts_ms, ups, ups + downs as total
        from (select query, cast(date_trunc('day', time_utc) as timestamp) as day,
                     cast(sum(ups) as bigint) as ups, cast(sum(downs) as bigint) as downs,
                     max(day) over (partition by query) as newest
              from votes group by query, day)
        where day >= newest - interval 20 day
    """, "votes"),
    "distinct_instants": _with("select distinct created_utc from minute_posts", "minute_posts"),
    "feed_newest2": _with("select query, doc_id, created_utc, rank from ranked where rank <= 2",
                          "ranked"),
    "feed_since": _with("""
        select p.query, p.doc_id, p.created_utc,
               row_number() over (partition by p.query order by p.created_utc desc, p.doc_id) as rank
        from posts p join cursors c on c.query = p.query and p.created_utc > c.lasttime
    """, "posts", "cursors"),
    "feed_since_ranged": _with("""
        select query, doc_id, created_utc, rank from ranked
        where query in (select query from word_topics)
    """, "ranked", "word_topics"),
    "feed_since_shuffled": _with("""
        select p.query, p.doc_id, p.created_utc
        from posts p join cursors c on c.query = p.query and p.created_utc > c.lasttime
    """, "posts", "cursors"),
    "feed_poll": _with("select * from polled", "polled"),
    "feed_top10": _with(f"""
        select rank, doc_id, query, created_utc from ({top10(f'''
            {WORD_POSTS} and subreddit <> 'click' and doc_id not in (
                select doc_id from posts where subreddit = 'purchase')''')})
    """, "posts", "word_topics"),
    "feed_top10_by_day": _with(f"""
        select rank, doc_id, query, created_utc from ({top10(f'''
            {WORD_POSTS} and subreddit <> 'click' and doc_id not in (
                select doc_id from posts where subreddit = 'purchase')''')})
    """, "posts", "word_topics"),
    "feed_render": _with(f"""
        select row_number() over (order by created_utc, doc_id) - 1 as ui_id, doc_id, query,
               strftime(created_utc, '%d/%m/%y, %H:%M:%S') as timestamp,
               case when length(url) > 28 then concat(substr(url, 1, 28), '...') else url end
                   as link_text,
               concat('http://reddit.com', permalink) as link,
               case when strpos(title, query) > 0
                    then concat(substr(title, 1, strpos(title, query) - 1),
                                '<span class=''highlight''>', query, '</span>',
                                substr(title, strpos(title, query) + length(query)))
                    else title end as title_html,
               ups, downs
        from ({top10(WORD_POSTS)})
    """, "posts", "word_topics"),
    "feed_cursor": _with("""
        select query, lasttime, strftime(lasttime, '%Y-%m-%dT%H:%M:%SZ') as instant
        from (select query, max(lasttime) as lasttime
              from (select query, created_utc as lasttime from polled
                    union all select query, lasttime from cursors)
              group by query)
    """, "polled", "cursors"),
    "merged_feed": _with("""
        select * from posts
        qualify row_number() over (partition by doc_id order by created_utc desc, query) = 1
    """, "posts"),
    "topic_list": """
        select p_partkey, cast(pos - 1 as integer) as pos, topics[pos] as topic
        from (select p_partkey, topics, unnest(range(1, len(topics) + 1)) as pos
              from (select p_partkey,
                           string_split(concat_ws(', ', p_name, p_brand, p_type), ',') as topics
                    from part))
    """,
    "enrich_by_id": _with("""
        select r.query, r.doc_id, r.rank,
               case when d.id is null then r.title else d.title end as title,
               case when d.id is null then r.url
                    when cast(d.id as bigint) % 3 <> 0 then d.url end as url,
               case when d.id is null then r.ups else d.ups end as ups,
               cast(d.gilded as bigint) as gilded
        from (select *, row_number() over (partition by query order by created_utc desc, doc_id)
                     as rank
              from posts where cast(doc_id as bigint) < 2 * (select count(*) from documents)
              qualify rank <= 2) r
        left join document_posts d on d.id = r.doc_id
    """, "posts", "document_posts"),
    "enrich_by_bloom": _with("""
        select r.query, r.doc_id, r.rank,
               case when d.id is null then r.title else d.title end as title,
               case when d.id is null then r.url
                    when cast(d.id as bigint) % 3 <> 0 then d.url end as url,
               case when d.id is null then r.ups else d.ups end as ups,
               cast(d.gilded as bigint) as gilded
        from (select *, row_number() over (partition by query order by created_utc desc, doc_id)
                     as rank
              from posts where cast(doc_id as bigint) < 2 * (select count(*) from documents)
              qualify rank <= 2) r
        left join document_posts d on d.id = r.doc_id
    """, "posts", "document_posts"),
    "new_ids": _with("""
        select doc_id from posts where contains(query, 'bolt')
        except
        select doc_id from posts where contains(query, 'blue')
    """, "posts"),
    "registry_upsert": _with("""
        select query, case when query in (select p_name from part)
                           then timestamp '2024-01-01' else timestamp '2024-01-02' end
                      as registered_at
        from part_registry
    """, "part_registry"),
    "registry_two_clients": _with("""
        select query, case when query in (select p_name from part)
                           then timestamp '2024-01-01' else timestamp '2024-01-02' end
                      as registered_at
        from part_registry
    """, "part_registry"),
    "votes_two_writers": _with("select * from votes", "votes"),
    "replay_order": """
        select n // 1250 as slice_id, count(*) as n, min(ts) as first_ts, max(ts) as last_ts
        from (select ts, row_number() over (order by ts, event_id) as n from events)
        group by slice_id
    """,
    "restart_new_checkpoint": _with(POSTS_ROUND, "posts"),
    "stream_cancelled": _with(POSTS_ROUND, "posts"),
    "stream_late_registry": _with("""
        select query, created_utc, id as doc_id, subreddit, title, permalink, url, author, ups, downs
        from event_matches
        where over_18 = false and (ups % 2 = 1 or contains(query, ' '))
        qualify row_number() over (partition by id order by query) <= 5
    """, "event_matches"),
    "batch_metrics": _with("""
        select ups % 3 as batch_id, count(*) as messages, true as timed
        from event_messages group by batch_id
    """, "event_messages"),
    "keyed_since": _with("""
        select query, doc_id, created_utc, ups,
               row_number() over (order by created_utc desc, doc_id) as rank
        from upserted
        where query = (select min(query) from word_topics)
          and created_utc > (select lasttime - interval 2 day from cursors
                             where query = (select min(query) from word_topics))
    """, "upserted", "word_topics", "cursors"),
    "keyed_newest2": _with("""
        select query, doc_id, created_utc, ups,
               row_number() over (order by created_utc desc, doc_id) as rank
        from upserted
        where query = (select min(query) from word_topics)
        qualify rank <= 2
    """, "upserted", "word_topics"),
    "keyed_topic_series": _with("""
        select * from series where query = (select min(query) from word_topics)
    """, "series", "word_topics"),
    "posts_upsert": _with("select * from upserted", "upserted"),
    "posts_compacted": _with("select * from upserted", "upserted"),
    "votes_upsert": _with("select * from votes", "votes"),
    "votes_from_changes": _with("""
        select query, cast(date_trunc('hour', created_utc) as timestamp) as time_utc,
               cast(sum(case when subreddit = 'signup' then ups * 2 else ups end) as bigint) as ups,
               cast(sum(downs) as bigint) as downs
        from minute_posts group by query, time_utc
    """, "minute_posts"),
    "scan_topics": _with("""
        select query, doc_id, ups, downs from upserted
        where query in (select query from word_topics)
    """, "upserted", "word_topics"),
    "replay_slices": """
        select n // 1250 as slice_id, count(*) as n, min(ts) as first_ts, max(ts) as last_ts
        from (select ts, row_number() over (order by ts, event_id) as n from events)
        group by slice_id
    """,
    "stream_posts": _with(POSTS_ROUND, "posts"),
    "delay_quantiles": """
        select share, count(*) as n, true as within
        from events, (values (0.1::double), (0.5::double), (0.9::double), (0.99::double)) as s(share)
        group by share
    """,
    "message_count": _with("""
        select 0::bigint as batch_id, count(*) as rows, count(*) as observed from event_messages
    """, "event_messages"),
    "stream_hourly": _with("""
        select query, time_utc, cast(sum(ups) as bigint) as ups, cast(sum(downs) as bigint) as downs
        from (select *, cast(date_trunc('hour', created_utc) as timestamp) as time_utc from posts
              where query in (select query from word_topics)
                and (cast(doc_id as bigint) % 7 <> 0
                     or floor(epoch(created_utc)) >= (
                         select floor((min(floor(epoch(created_utc)))
                                       + max(floor(epoch(created_utc)))) / 2) from posts)))
        where time_utc + interval 1 hour
            <= (select max(created_utc) from posts) - interval 2 hour
        group by query, time_utc
    """, "posts", "word_topics"),
    "stream_hourly_live": _with("""
        select query, time_utc, cast(sum(ups) as bigint) as ups, cast(sum(downs) as bigint) as downs
        from (select *, cast(date_trunc('hour', created_utc) as timestamp) as time_utc from posts
              where query in (select query from word_topics))
        where time_utc + interval 1 hour
            <= (select max(created_utc) from posts) - interval 2 hour
          and (query < 'm' or time_utc + interval 1 hour > (
              select max(created_utc) from posts
              where floor(epoch(created_utc)) < (
                  select floor((min(floor(epoch(created_utc)))
                                + max(floor(epoch(created_utc)))) / 2) from posts))
              - interval 2 hour)
        group by query, time_utc
    """, "posts", "word_topics"),
    "stream_registrations": _with("""
        select query, id as doc_id, created_utc
        from (select *, (select date_trunc('day', min(created_utc)) from event_messages)
                        + case when contains(query, ' ') then interval 12 day
                               else interval 0 day end as registered_at
              from event_matches)
        where created_utc between registered_at and registered_at + interval 10 day
    """, "event_matches"),
    "stream_panes": _with(f"""
        select query, until_utc, count(*) as n from ({SLIDES})
        where until_utc <= (select max(created_utc) from posts) - interval 10 minute
        group by query, until_utc
    """, "posts"),
    "stream_slides": _with(f"""
        select query, until_utc, count(*) as n from ({SLIDES})
        where until_utc <= (select max(created_utc) from posts) - interval 10 minute
        group by query, until_utc
    """, "posts"),
    "stream_feed": _with(f"select doc_id, query, created_utc from ({top10(WORD_POSTS)})",
                         "posts", "word_topics"),
    "stream_shown_once": _with("select doc_id, min(query) as query from posts group by doc_id",
                               "posts"),
    "stream_cursor": _with("select query, max(created_utc) as lasttime from posts group by query",
                           "posts"),
    "stream_cursor_state": _with("select query, max(created_utc) as lasttime from posts group by query",
                                 "posts"),
}
