"""Oracle SQL of the registered queries, for an ANSI engine over the same Parquet tables.

Every query states the plain definition, with full cross products and whole windows where the Spark
side takes another way. Shared views are put in front as common table expressions.
"""

from __future__ import annotations

import re

DOT = "round(list_inner_product(u.vec::DOUBLE[], i.vec::DOUBLE[]), 6)"


def hash8(*parts) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(map(str, parts))})), 1, 8))::BIGINT"


def hash15(*parts) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(map(str, parts))})), 1, 15))::BIGINT"


def drawn(source: str, keys: str, size: str, want: str, seed: int) -> str:
    """Rows (keys, slot, position): the first places of a keyed permutation of [0, size), slots from 1.

    The permutation adds hashes to the row and the column of a grid in turn, and walks on from places outside [0, size).
    """

    def once(source: str) -> str:
        step = f"select *, (x - x % b) // b as l, x % b as r from ({source}) s0"
        for i in range(1, 5):
            moved = f"(l + {hash15(seed, keys, i, 'r')}) % a as l, r" if i % 2 else f"l, (r + {hash15(seed, keys, i, 'l')}) % b as r"
            step = f"select {keys}, n, w, a, b, j, {moved} from ({step}) s{i}"
        return f"select {keys}, n, w, a, b, j, l * b + r as x from ({step}) e"

    sized = f"""select *, (n + a - 1) // a as b from (select *, cast(ceil(sqrt(cast(n as double))) as bigint) as a from (
        select {keys}, cast({size} as bigint) as n, cast({want} as bigint) as w from {source}) z where w > 0 and n > 0) y"""
    start = f"select *, unnest(range(least(n, w))) as j, unnest(range(least(n, w))) as x from ({sized}) v"
    return f"""with recursive walk as ({once(start)} union all {once('select * from walk where x >= n')})
      select {keys}, j + 1 as slot, x as position from walk where x < n"""


VIEWS = {
    "sessions": """select cast(floor(event_id / 10) as bigint) as session_id, ts as timestamp, user_id,
        case event_type when 'purchase' then 'like' when 'error' then 'skip'
                        when 'signup' then 'advertisement' else 'play' end as event_type,
        case when event_type = 'signup' then null
             else cast(regexp_extract(props, '([0-9]+)', 1) as bigint) end as track_id
      from events""",
    "tracks": """select p_partkey as id, p_partkey % 27 as id_artist, p_name as name, p_partkey % 101 as popularity,
        cast(p_size * 6000 as bigint) as duration_ms, cast(p_size as double) as tempo, p_retailprice as loudness,
        make_date(1960 + p_size, 1, 1) as release_date
      from part where p_partkey % 9 <> 0""",
    "released": """select * from tracks union all
      select -id, id_artist, name, popularity + 1, duration_ms, tempo, loudness, release_date from tracks where id % 7 = 0""",
    "artists": """select cast(n_nationkey as bigint) as id, n_name as name, r_name as genre
      from nation join region on n_regionkey = r_regionkey""",
    "user_genres": """select distinct c_custkey as user_id, r_name as genre
      from customer join region on r_regionkey in (c_nationkey % 5, c_custkey % 5)""",
    "session_ids": "select distinct user_id from sessions",
    "requests": """select o_orderkey as request_id, o_custkey % 20 as user_id, o_custkey as guest_id,
        cast(o_orderkey % 23 as int) - 2 as playlist_length,
        timestamp '2024-01-01 00:00:00' + to_days(cast(o_orderkey % 28 as int)) as timestamp
      from orders""",
    "request_members": """select request_id, user_id from requests
      union select request_id, (user_id * 7 + 1) % 20 from requests
      union select request_id, guest_id from requests""",
    "item_vec": "select t.id as track_id, e.embedding as vec from tracks t join embeddings e on e.vec_id = t.id % 400",
    "user_vec": """select u.user_id, e.embedding as vec from session_ids u
      join embeddings e on e.vec_id = 400 + u.user_id % 100""",
    "likes": """select distinct s.user_id, s.track_id from sessions s join tracks t on t.id = s.track_id
      where event_type = 'like'""",
    "weights": """select user_id, track_id, count(*) as weight from sessions
      where event_type = 'like' group by user_id, track_id""",
    "features": """select distinct id, id_artist, popularity, duration_ms, tempo, loudness,
        cast(extract(year from release_date) as bigint) as release_year from tracks""",
    "history": f"""select *, row_number() over (partition by user_id order by {hash8('track_id')} % 16, track_id) - 1 as pos
      from likes""",
    "sizes": "select user_id, count(*) as n from likes group by user_id",
    "names": """select distinct t.id as track_id, t.name as track_name, a.id as artist_id, a.name as artist_name
      from tracks t join artists a on t.id_artist = a.id""",
    "track_index": f"select id as track_id, row_number() over (order by {hash8('id')} % 64, id) - 1 as idx from tracks",
    "user_index": f"""select user_id, row_number() over (order by {hash8('user_id')} % 64, user_id) - 1 as idx
      from session_ids""",
    "split": f"select *, {hash8(42, 'user_id', 'track_id')} % 100 < 80 as is_train from likes",
    "scores": f"select u.user_id, i.track_id, {DOT} as score from user_vec u cross join item_vec i",
    "ranks": """select *, row_number() over (partition by user_id order by score desc, track_id) - 1 as rank
      from scores""",
    "request_group": """select f.request_id, f.position, f.track_id, f.mean_rank from (
        select *, row_number() over (partition by request_id order by mean_rank, track_id) as position from (
          select m.request_id, r.track_id, avg(r.rank) as mean_rank from request_members m
          join ranks r on r.user_id = m.user_id group by m.request_id, r.track_id) a) f
      join requests q on q.request_id = f.request_id where f.position <= q.playlist_length""",
    "pool": """select m.request_id, m.user_id, s.n,
        sum(s.n) over (partition by m.request_id order by m.user_id) as hi from request_members m
      join sizes s on s.user_id = m.user_id""",
    "pooled": """select q.request_id, q.playlist_length, sum(p.n) as total from requests q
      join pool p on p.request_id = q.request_id group by q.request_id, q.playlist_length""",
    "pool_draws": drawn("pooled", "request_id", "total", "playlist_length", 7),
    "request_base": """select d.request_id, d.slot as position, h.track_id, q.total < q.playlist_length as short
      from pool_draws d join pool p on p.request_id = d.request_id and d.position >= p.hi - p.n and d.position < p.hi
      join history h on h.user_id = p.user_id and h.pos = d.position - (p.hi - p.n)
      join pooled q on q.request_id = d.request_id""",
    "candidates": """select s.*, case when x.is_train = false then 1 else 0 end as pos from scores s
      left join split x on x.user_id = s.user_id and x.track_id = s.track_id
      where x.is_train is null or x.is_train = false""",
    "candidate_ranks": """select *, count(*) over (partition by user_id order by score desc
          range between unbounded preceding and current row) - 1 as r,
        count(*) over (partition by user_id) as n, cast(sum(pos) over (partition by user_id) as bigint) as p
      from candidates""",
    "positives": """select *, row_number() over (partition by user_id order by r, track_id) - 1 as j
      from candidate_ranks where pos = 1""",
    "cold": "select c_custkey as user_id from customer where c_custkey not in (select user_id from session_ids)",
    "group_sizes": f"""select s_suppkey as group_id, 2 + {hash15(3, "'size'", 's_suppkey')} % 8 as w,
        (select count(*) from session_ids) as n from supplier""",
    "group_draws": drawn("group_sizes", "group_id", "n", "w", 3),
    "group_members": """select d.group_id, u.user_id from group_draws d join user_index u on u.idx = d.position""",
    "answers": """select q.request_id, case when q.user_id % 2 = 0 then 'base' else 'advanced' end as model,
        b.position, b.track_id from requests q join request_base b on b.request_id = q.request_id
      where q.user_id % 2 = 0
      union all
      select q.request_id, 'advanced', g.position, g.track_id from requests q
      join request_group g on g.request_id = q.request_id where q.user_id % 2 = 1
      union all
      select q.request_id, 'advanced', d.slot, t.track_id from lost_draws d
      join requests q on q.request_id = d.request_id join track_index t on t.idx = d.position""",
    "lost": """select request_id, playlist_length, (select count(*) from tracks) as n from requests
      where user_id % 2 = 1 and playlist_length >= 0 and request_id not in (
        select request_id from request_members where user_id in (select user_id from session_ids))""",
    "lost_draws": drawn("lost", "request_id", "n", "playlist_length", 7),
    "user_sessions": "select user_id, session_id, min(timestamp) as at from sessions group by user_id, session_id",
    "later": """select * from (
        select m.request_id, s.user_id, s.session_id,
          row_number() over (partition by m.request_id, s.user_id order by s.at, s.session_id) as k
        from request_members m join requests q on q.request_id = m.request_id
        join user_sessions s on s.user_id = m.user_id and s.at > q.timestamp where q.playlist_length >= 0) a
      where k <= 20""",
    "timed": """select a.request_id, a.track_id, cast(sum(t.duration_ms) as double) as duration
      from answers a join tracks t on t.id = a.track_id group by a.request_id, a.track_id""",
    "uptake": """select q.request_id, case when q.user_id % 2 = 0 then 'base' else 'advanced' end as model,
        coalesce(p.played / t.total, 0) as best_share from requests q
      left join (select request_id, sum(duration) as total from timed group by request_id) t
        on t.request_id = q.request_id
      left join (select request_id, max(played) as played from (
          select l.request_id, l.user_id, l.session_id, sum(t.duration) as played
          from later l
          join (select distinct user_id, session_id, track_id from sessions
                where event_type = 'play' and track_id is not null) y
            on y.user_id = l.user_id and y.session_id = l.session_id
          join timed t on t.request_id = l.request_id and t.track_id = y.track_id
          group by l.request_id, l.user_id, l.session_id) z group by request_id) p on p.request_id = q.request_id
      where q.playlist_length >= 0""",
    "trials": """select s_suppkey as trial, 1.0 / (1 + s_suppkey % 37) as learning_rate,
        1.0 / (1 + s_suppkey % 101) as item_alpha, 5 + s_suppkey % 75 as no_components,
        0.5 + (s_suppkey * 7919 % 1000) / 2000.0 as auc_test,
        (s_suppkey * 104729 % 997) / 997.0 as clustering_fm,
        1.0 + (s_suppkey * 1299709 % 991) / 991.0 as clustering_base from supplier""",
}


def spread(playlists: str, keys: str) -> str:
    """Mean distance to the centroid of each playlist; ``playlists`` has (keys, track_id)."""
    return f"""select {keys}, avg(dist) as spread, count(*) as n_tracks from (
        select {keys}, rid, sqrt(sum((x - c) * (x - c))) as dist from (
          select *, avg(x) over (partition by {keys}, d) as c from (
            select {keys}, rid, unnest(range(len(vec))) as d, unnest(vec)::DOUBLE as x from (
              select p.*, i.vec, row_number() over () as rid from ({playlists}) p
              join item_vec i on i.track_id = p.track_id) a) b) e
        group by {keys}, rid) f group by {keys}"""


def with_views(body: str) -> str:
    """Put the views that ``body`` needs, in order of dependency, in front of it."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b(from|join) {name}\b", sql):
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "with " + ",\n".join(f"{name} as materialized ({VIEWS[name]})" for name in needed) + "\n" + body


FEATURES = ("popularity", "duration_ms", "tempo", "loudness", "release_year")
MODEL_OF = "case when user_id % 2 = 0 then 'base' else 'advanced' end"
METRIC = "select count(*) as n_users, round(avg(a), 6) as {name} from (select user_id, {value} as a from positives group by user_id) z"


def zscores(cast: str = "double") -> str:
    return ", ".join(
        f"round((f.{c} - avg(f.{c}) over ()) / nullif(stddev_pop(f.{c}) over (), 0), 6) as {c}" for c in FEATURES
    )


CANDIDATES = f"""select trial, round(pow(10, -5.0 + lr * 4.3), 6) as learning_rate,
        round(pow(10, -6.0 + ia * 5.0), 6) as item_alpha, round(pow(10, -6.0 + ua * 5.0), 6) as user_alpha,
        5 + cast(floor(nc * 75) as bigint) as no_components, 10::BIGINT as epochs from (
        select s_suppkey as trial, {hash15(1, "'learning_rate'", 's_suppkey')} % 1000000000 / 1e9 as lr,
          {hash15(1, "'item_alpha'", 's_suppkey')} % 1000000000 / 1e9 as ia,
          {hash15(1, "'user_alpha'", 's_suppkey')} % 1000000000 / 1e9 as ua,
          {hash15(1, "'no_components'", 's_suppkey')} % 1000000000 / 1e9 as nc from supplier) a"""

BODIES = {
    "sessions_scan": "select session_id, timestamp, user_id, event_type, track_id from sessions",
    "track_features": "select * from features",
    "session_users": "select user_id from session_ids",
    "profile_users": "select c_custkey as user_id from customer",
    "liked_pairs": "select distinct user_id, track_id from sessions where event_type = 'like'",
    "like_weights": "select user_id, track_id, weight from weights",
    "like_weights_features": """select w.user_id, w.track_id, w.weight, t.popularity, t.duration_ms, t.tempo, t.loudness,
        cast(extract(year from t.release_date) as bigint) as release_year
      from weights w join tracks t on t.id = w.track_id""",
    "interactions_binary": "select user_id, track_id, 1.0::DOUBLE as w from likes",
    "interaction_stats": """select (select count(*) from session_ids) as n_users, (select count(*) from tracks) as n_items,
        (select count(*) from likes) as n_interactions""",
    "feature_zscore": f"select f.id, f.id_artist, {zscores()} from features f",
    "item_features_long": f"""select id as track_id, feature, value from (
        select f.id, {zscores()} from features f) z
      unpivot (value for feature in ({', '.join(FEATURES)}))""",
    "id_index": f"""select 'user' as side, user_id as id, idx from user_index
      union all select 'track', track_id, idx from track_index""",
    "split_train_test": "select user_id, track_id, is_train from split",
    "track_artist_names": "select track_id, track_name, artist_id, artist_name from names",
    "cold_users": "select user_id from cold",
    "request_members": "select request_id, user_id from request_members",
    "request_validation": """select request_id, user_id, playlist_length,
        case when playlist_length < 0 then 'negative playlist_length' end as reason from requests""",
    "rejected_requests": """select request_id, user_id, playlist_length, 'negative playlist_length' as reason
      from requests where playlist_length < 0""",
    "ab_assignment": f"""select c_custkey as user_id, case when c_custkey % 2 = 0 then 'base' else 'advanced' end as model
      from customer
      union all select -1 - c_custkey, case when c_custkey = 0 or (1 + c_custkey) % 2 = 0 then 'base' else 'advanced' end
      from customer""",
    "history_sample_user": f"""select d.user_id, d.slot as position, h.track_id, s.n < 10 as short
      from ({drawn('sizes', 'user_id', 'n', '10', 7)}) d
      join history h on h.user_id = d.user_id and h.pos = d.position join sizes s on s.user_id = d.user_id""",
    "history_sample_group": "select request_id, position, track_id, short from request_base",
    "random_tracks": f"""select d.request_id, d.slot as position, t.track_id
      from ({drawn('(select request_id, playlist_length, (select count(*) from tracks) as n from requests)',
                   'request_id', 'n', 'playlist_length', 7)}) d join track_index t on t.idx = d.position""",
    "random_groups": "select group_id, user_id from group_members",
    "cold_user_playlist": f"""select d.user_id, d.slot as position, t.track_id
      from ({drawn('(select user_id, (select count(*) from tracks) as n from cold)', 'user_id', 'n', '20', 7)}) d
      join track_index t on t.idx = d.position""",
    "user_scores": "select user_id, track_id, score from scores",
    "user_ranks": "select user_id, track_id, score, rank from ranks",
    "user_topk": "select user_id, rank + 1 as position, track_id, score from ranks where rank < 20",
    "user_topk_unseen": """select user_id, position, track_id, score from (
        select s.*, row_number() over (partition by s.user_id order by s.score desc, s.track_id) as position
        from scores s left join likes l on l.user_id = s.user_id and l.track_id = s.track_id
        where l.user_id is null) a where position <= 20""",
    "group_playlist": "select request_id, position, track_id, round(mean_rank, 6) as mean_rank from request_group",
    "group_playlist_truncated": """select request_id, position, track_id, round(mean_rank, 6) as mean_rank from (
        select a.*, q.playlist_length, row_number() over (partition by a.request_id order by mean_rank, track_id) as position
        from (select m.request_id, r.track_id, avg(r.rank) as mean_rank, count(*) as c from request_members m
              join ranks r on r.user_id = m.user_id where r.rank < 200 group by m.request_id, r.track_id) a
        join (select request_id, count(*) as members from request_members
              where user_id in (select user_id from session_ids) group by request_id) g on g.request_id = a.request_id
        join requests q on q.request_id = a.request_id where a.c = g.members) f where position <= playlist_length""",
    "group_playlist_weighted": """select f.request_id, f.position, f.track_id, round(f.mean_rank, 6) as mean_rank from (
        select *, row_number() over (partition by request_id order by mean_rank, track_id) as position from (
          select m.request_id, r.track_id,
            sum(r.rank * case when coalesce(s.n, 0) >= 10 then 1.0 else 0.5 end)
              / sum(case when coalesce(s.n, 0) >= 10 then 1.0 else 0.5 end) as mean_rank
          from request_members m join ranks r on r.user_id = m.user_id left join sizes s on s.user_id = m.user_id
          group by m.request_id, r.track_id) a) f
      join requests q on q.request_id = f.request_id where f.position <= q.playlist_length""",
    "group_playlist_product": """select request_id, position, track_id, product from (
        select *, row_number() over (partition by request_id order by product desc, track_id) as position from (
          select request_id, track_id,
            round(case when min(scaled) <= 0 then 0 else exp(sum(ln(case when scaled > 0 then scaled end))) end, 6) as product
          from (select m.request_id, r.track_id, r.rank, g.members,
                  (r.score - e.low) / nullif(e.high - e.low, 0) as scaled
                from request_members m join ranks r on r.user_id = m.user_id
                join (select user_id, min(score) as low, max(score) as high from scores group by user_id) e
                  on e.user_id = r.user_id
                join (select request_id, count(*) as members from request_members
                      where user_id in (select user_id from session_ids) group by request_id) g
                  on g.request_id = m.request_id
                where r.rank < 100 * g.members) a
          group by request_id, track_id, members having count(*) = members) b) c
      join requests q using (request_id) where position <= playlist_length""",
    "group_common_tracks": """select m.request_id, r.track_id from request_members m join ranks r on r.user_id = m.user_id
      join (select request_id, count(*) as members from request_members
            where user_id in (select user_id from session_ids) group by request_id) g on g.request_id = m.request_id
      where r.rank < 200 group by m.request_id, r.track_id, g.members having count(*) = g.members""",
    "list_overlap": """select p.user_a, p.user_b, count(y.track_id) as n_shared,
        round(count(y.track_id) * 100.0 / 200, 6) as percent_shared
      from (select distinct q.user_id as user_a, m.user_id as user_b from requests q
            join request_members m on m.request_id = q.request_id
            where q.user_id <> m.user_id and m.user_id in (select user_id from session_ids)) p
      join ranks x on x.user_id = p.user_a and x.rank < 200
      left join ranks y on y.user_id = p.user_b and y.track_id = x.track_id and y.rank < 200
      group by p.user_a, p.user_b""",
    "playlist_entries": """select g.request_id, g.position, g.track_id as id, n.track_name as name, n.artist_name as artist
      from request_group g join names n on n.track_id = g.track_id""",
    "playlist_spread": f"""select request_id, round(spread, 6) as spread, n_tracks
      from ({spread('select request_id, track_id from request_group', 'request_id')}) s""",
    "spread_by_length": f"""select length, count(*) as n_playlists, round(avg(spread), 6) as mean_spread from (
        {spread('select g.request_id, l.length, g.track_id from request_group g join (select unnest([5, 10, 15, 20]) as length) l on g.position <= l.length',
                'request_id, length')}) s group by length""",
    "random_spread": f"""select count(*) as n_playlists, round(avg(spread), 6) as mean_spread from (
        {spread(f'''select d.rep, t.track_id from ({drawn(
            '(select s_suppkey as rep, (select count(*) from tracks) as n from supplier)', 'rep', 'n', '20', 7)}) d
          join track_index t on t.idx = d.position''', 'rep')}) s""",
    "model_spread": f"""select count(*) as n_groups, round(avg(a.spread), 6) as clustering_fm,
        round(avg(b.spread), 6) as clustering_base,
        round((avg(b.spread) - avg(a.spread)) * 100 / avg(b.spread), 6) as percent_better
      from ({spread('''select group_id, track_id from (
          select *, row_number() over (partition by group_id order by mean_rank, track_id) as position from (
            select m.group_id, r.track_id, avg(r.rank) as mean_rank from group_members m
            join ranks r on r.user_id = m.user_id group by m.group_id, r.track_id) a) b where position <= 20''',
          'group_id')}) a
      join ({spread(f'''select d.group_id, h.track_id
          from ({drawn('(select group_id, sum(n) as total from group_members join sizes using (user_id) group by group_id)',
                       'group_id', 'total', '20', 7)}) d
          join (select m.group_id, m.user_id, s.n, sum(s.n) over (partition by m.group_id order by m.user_id) as hi
                from group_members m join sizes s on s.user_id = m.user_id) p
            on p.group_id = d.group_id and d.position >= p.hi - p.n and d.position < p.hi
          join history h on h.user_id = p.user_id and h.pos = d.position - (p.hi - p.n)''', 'group_id')}) b
      on a.group_id = b.group_id""",
    "eval_candidates": """select user_id, track_id, score, r as rank, j as place, n as n_candidates, p as n_positives
      from positives""",
    "eval_auc": METRIC.format(name="auc", value="avg(1 - greatest(r - j, 0) / cast(n - p as double))"),
    "eval_precision_at_10": METRIC.format(name="precision", value="sum(case when r < 10 then 1 else 0 end) / 10.0"),
    "eval_recall_at_10": METRIC.format(name="recall", value="sum(case when r < 10 then 1 else 0 end) / cast(max(p) as double)"),
    "eval_reciprocal_rank": METRIC.format(name="reciprocal_rank", value="max(1.0 / (r + 1))"),
    "eval_precision_at_100": METRIC.format(name="precision", value="sum(case when r < 100 then 1 else 0 end) / 100.0"),
    "eval_recall_at_100": METRIC.format(name="recall", value="sum(case when r < 100 then 1 else 0 end) / cast(max(p) as double)"),
    "tuning_candidates": CANDIDATES,
    "tuning_log": f"""select *, true as metrics_in_range, true as percent_agrees, true as timed
      from ({CANDIDATES}) c""",
    "tuning_top20": """select name, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std from (
        select * from (select learning_rate::DOUBLE as learning_rate, item_alpha::DOUBLE as item_alpha,
            no_components::DOUBLE as no_components, auc_test::DOUBLE as auc_test,
            clustering_fm::DOUBLE as clustering_fm, clustering_base::DOUBLE as clustering_base
          from trials order by trials.auc_test desc, trial limit 20) t
        unpivot (v for name in (learning_rate, item_alpha, no_components, auc_test, clustering_fm, clustering_base))) u
      group by name""",
    "ab_playlists": "select request_id, model, position, track_id from answers",
    "score_requests": """select a.request_id, a.model, a.position, a.track_id as id, n.track_name as name,
        n.artist_name as artist from answers a join names n on n.track_id = a.track_id""",
    "prediction_history": f"""select q.request_id, q.user_id,
        concat_ws(',', (q.user_id * 7 + 1) % 20, q.guest_id) as other_users,
        coalesce(p.playlist, '') as playlist, q.timestamp, {MODEL_OF.replace('user_id', 'q.user_id')} as model, true as is_ab
      from requests q left join (select request_id, string_agg(track_id::VARCHAR, ',' order by position) as playlist
                                 from answers group by request_id) p on p.request_id = q.request_id
      where q.playlist_length >= 0""",
    "implied_ratings": """select user_id, track_id, n_play, n_like, n_skip,
        round((n_play * 1.0 + n_like * 3.0 - n_skip * 2.0) / (n_play + n_like + n_skip), 6) as rating from (
        select user_id, track_id, count(*) filter (event_type = 'play') as n_play,
          count(*) filter (event_type = 'like') as n_like, count(*) filter (event_type = 'skip') as n_skip
        from sessions where event_type in ('play', 'like', 'skip') and track_id is not null
        group by user_id, track_id) a""",
    "recency_weights": """select user_id, track_id,
        round(sum(exp(-(epoch_us(m) - epoch_us(timestamp)) / 86400000000.0 / 7.0)), 6) as weight
      from sessions, (select max(timestamp) as m from sessions) x
      where event_type in ('like', 'play') and track_id is not null group by user_id, track_id""",
    "popularity_fallback": """select c.user_id, t.position, t.track_id, t.popularity from cold c cross join (
        select id as track_id, popularity, row_number() over (order by popularity desc, id) as position
        from tracks) t where t.position <= 10""",
    "genre_fallback": """select user_id, position, track_id, n_genres from (
        select c.user_id, t.id as track_id, count(*) as n_genres,
          row_number() over (partition by c.user_id order by count(*) desc, t.popularity desc, t.id) as position
        from cold c join user_genres g on g.user_id = c.user_id join artists a on a.genre = g.genre
        join tracks t on t.id_artist = a.id group by c.user_id, t.id, t.popularity) z where position <= 10""",
    "dq_report": """select 'artists' as table_name, 'missing_id' as rule, count(*) filter (id is null or id = -1) as n_bad from artists
      union all select 'artists', 'missing_genres', count(*) filter (genre is null) from artists
      union all select 'tracks', 'missing_id', count(*) filter (id is null) from tracks
      union all select 'sessions', 'missing_session_id', count(*) filter (session_id is null) from sessions
      union all select 'sessions', 'missing_user', count(*) filter (user_id is null) from sessions
      union all select 'sessions', 'missing_event_type', count(*) filter (event_type is null) from sessions
      union all select 'sessions', 'missing_track',
        count(*) filter (track_id is null and coalesce(event_type, '') <> 'advertisement') from sessions
      union all select 'sessions', 'repeated_timestamp', cast(coalesce(sum(n), 0) as bigint) from (
        select count(*) as n from sessions group by session_id, timestamp having count(*) > 1) r
      union all select 'users', 'missing_genres', 0::BIGINT from customer having count(*) >= 0""",
    "rereleases": """select id_artist, name, duration_ms, tempo, loudness, release_date, count(*) as n_releases,
        min(id) as first_id, max(popularity) as popularity from released group by all having count(*) > 1""",
    "collapse_rereleases": """select id_artist, name, duration_ms, tempo, loudness, release_date, min(id) as id,
        max(popularity) as popularity from released group by all""",
    "als_train": "select distinct track_id, 16::BIGINT as n_factors from split where is_train",
    "model_save_load": "select distinct user_id, true as same from split where is_train",
    "eval_report": """select (select count(distinct user_id) from split where is_train) as n_users_train,
        (select count(distinct user_id) from split where not is_train
           and user_id in (select user_id from split where is_train)
           and track_id in (select track_id from split where is_train)) as n_users_test,
        true as auc_train_in_range, true as precision_train_in_range, true as recall_train_in_range,
        true as reciprocal_rank_train_in_range, true as auc_test_in_range, true as precision_test_in_range,
        true as recall_test_in_range, true as reciprocal_rank_test_in_range, true as better_than_chance""",
    "cold_item_factors": """select id as track_id, 16::BIGINT as n_factors from features
      where id not in (select track_id from split where is_train)""",
    "playlist_uptake": """select request_id, model, round(best_share, 6) as best_share, best_share >= 0.35 as met
      from uptake""",
    "ab_outcome": """select model, count(*) as n_runs, count(*) filter (best_share >= 0.35) as n_met,
        round(avg(case when best_share >= 0.35 then 1.0 else 0.0 end), 6) as part_met,
        avg(case when best_share >= 0.35 then 1.0 else 0.0 end) >= 0.25 as target_met from uptake group by model""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(body) for name, body in BODIES.items()}
