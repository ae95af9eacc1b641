"""The registered queries in DuckDB's SQL, over the driver's tables.

``VIEWS`` are the SQL twins of ``adapters`` and of the intermediate results;
each oracle is its own SELECT behind the views it needs.
"""

from __future__ import annotations

import re

from marquee.registry.adapters import DIRECTORS_PER_ROW
from marquee.registry.queries import DIGITS, GENRE, TITLE_ID
from marquee.schemas import COPIED_TABLES, RAW_SCHEMAS


def _id(prefix: str, key: str) -> str:
    return f"printf('{prefix}%07d', cast({key} as bigint))"


def _two_decimals(number: str) -> str:
    moved = (
        f"case when abs({number} * 8) % 2 = 1 then {number} + sign({number}) * 0.001 "
        f"else {number} end"
    )
    return f"format('{{:.2f}}', {moved})"


VIEWS = {
    "title_basics": f"""
        select {_id("tt", "p_partkey")} as tconst,
               case when p_type = 'SMALL' then 'movie' when p_type = 'LARGE' then 'short'
                    else lower(p_type) end as titleType,
               p_name as primaryTitle, p_name as originalTitle, 0 as isAdult,
               case when p_partkey % 13 = 0 then null
                    else cast(1900 + 2 * p_size as int) end as startYear,
               cast(null as varchar) as endYear,
               cast(p_size * 3 as varchar) as runtimeMinutes,
               case when p_partkey % 11 = 0 then null
                    else replace(p_name, ' ', ',') end as genres
        from part""",
    "title_ratings": f"""
        select {_id("tt", "l_partkey")} as tconst,
               cast(round(avg(l_quantity) / 5.0, 1) as varchar) as averageRating,
               cast(count(*) as int) as numVotes
        from lineitem where l_partkey % 7 <> 0 group by l_partkey""",
    "name_basics": f"""
        select {_id("nm", "s_suppkey")} as nconst,
               case when s_suppkey % 10 = 0 then 'Homonym' else s_name end as primaryName
        from supplier""",
    "title_crew": f"""
        select {_id("tt", "l_partkey")} as tconst,
               string_agg(distinct {_id("nm", "l_suppkey")}, ','
                          order by {_id("nm", "l_suppkey")}) as directors
        from lineitem group by l_partkey, l_suppkey // {DIRECTORS_PER_ROW}""",
    "title_akas": f"""
        select {_id("tt", "p_partkey")} as titleId, cast(n_nationkey + 1 as int) as ordering,
               p_name || ' ' || n_name as title, n_name as region, lower(r_name) as language,
               cast(null as varchar) as types, cast(null as varchar) as attributes,
               case when n_nationkey = 0 then '1' else '0' end as isOriginalTitle
        from part join nation on p_partkey % 25 = n_nationkey
                  join region on n_regionkey = r_regionkey""",
    "title_episode": f"""
        select {_id("ep", "l_orderkey")} || '-' || cast(l_linenumber as varchar) as tconst,
               {_id("tt", "l_partkey")} as parentTconst,
               cast(l_linenumber as int) as seasonNumber,
               cast(trunc(l_quantity) as int) as episodeNumber
        from lineitem""",
    "title_principals": f"""
        select {_id("tt", "l_partkey")} as tconst, cast(l_linenumber as int) as ordering,
               {_id("nm", "l_suppkey")} as nconst,
               case when l_returnflag = 'A' then 'actor' when l_returnflag = 'N' then 'director'
                    else 'writer' end as category,
               cast(null as varchar) as job, cast(null as varchar) as characters
        from lineitem""",
    "vote_messages": f"""
        select event_id as msg_offset, ts,
               case when event_type = 'error' then '"bad"'
                    else '"' || {_id("tt", "user_id")} || '_'
                         || cast(1 + event_id % 5 as varchar) || '"' end as value
        from events""",
    "votes_parsed": """
        select msg_offset, ts, trim(p[1]) as tconst, try_cast(trim(p[2]) as int) as vote
        from (select *, string_split(value[2:-2], '_') as p from vote_messages)
        where len(p) = 2 and try_cast(trim(p[2]) as int) is not null""",
    # epoch_ms would round; whole milliseconds are cut off.
    "votes": """
        select msg_offset, tconst, epoch_us(ts) // 1000 as ts_ms, vote from votes_parsed""",
    "vote_latest": """
        select tconst, ts_ms, arg_max(vote, msg_offset) as vote from votes group by all""",
    "vote_totals": """
        select tconst, count(*) as dn, cast(sum(vote) as bigint) as ds from votes group by all""",
    "genre_by_decade": """
        select cast(floor(startYear / 10) * 10 as bigint) as decade, genre, count(*) as count
        from (select startYear, unnest(string_split(genres, ',')) as genre
              from title_basics where startYear is not null)
        group by 1, 2""",
    "votes_by_title_type": """
        select titleType, cast(sum(numVotes) as bigint) as totalVotes
        from title_basics join title_ratings using (tconst) group by titleType""",
    "crew_ratings": """
        select tconst, directors, averageRating from title_crew join title_ratings using (tconst)
        where directors is not null and averageRating is not null""",
    "movie_titles": """
        select tconst, titleType from title_basics where titleType = 'movie'""",
    "movie_crew_ratings": """
        select * from crew_ratings join movie_titles using (tconst)""",
    "director_titles": """
        select primaryName, averageRating, tconst
        from (select tconst, averageRating, unnest(string_split(directors, ',')) as director
              from movie_crew_ratings)
        join name_basics on director = nconst""",
    # Ratings have one decimal. Their sum as DECIMAL is exact; as DOUBLE it would
    # change with the order of the rows, and with it the rounding of exact halves.
    "director_means": """
        select primaryName, count(tconst) as movieCount,
               cast(sum(cast(averageRating as decimal(18, 1))) as double) / count(averageRating)
                   as mean
        from director_titles group by primaryName""",
    "weighted_scores": f"""
        select primaryName, round(mean, {DIGITS}) as averageRating, movieCount,
               round(mean * ln(movieCount + 1), {DIGITS}) as weightedScore
        from director_means""",
    "top_directors": """
        select * from weighted_scores order by weightedScore desc, primaryName limit 25""",
    "merged": """
        select r.tconst,
               case when dn is null then cast(averageRating as double)
                    else (cast(averageRating as double) * numVotes + ds) / (numVotes + dn) end
                   as averageRating,
               cast(numVotes + coalesce(dn, 0) as bigint) as numVotes, dn
        from title_ratings r left join vote_totals a on r.tconst = a.tconst""",
    "decade_list": "select distinct decade from genre_by_decade",
}


def _with_views(select: str) -> str:
    """The SELECT behind the views it names, directly or through other views."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", sql):
                needed.add(name)
                visit(VIEWS[name])

    visit(select)
    ctes = ",\n".join(f"{name} as ({sql})" for name, sql in VIEWS.items() if name in needed)
    body = select.strip()
    if body.startswith("with "):
        return f"with {ctes},\n{body.removeprefix('with ')}"
    return f"with {ctes}\n{body}"


def _raw_columns(table: str) -> list[str]:
    """Raw columns of a table, those its view lacks as NULL."""
    missing = {
        "name_basics": ("birthYear", "deathYear", "primaryProfession", "knownForTitles"),
        "title_crew": ("writers",),
    }.get(table, ())
    kinds = {"string": "varchar", "int": "int"}
    columns = []
    for field in RAW_SCHEMAS[table]:
        source = "null" if field.name in missing else field.name
        columns.append(f"cast({source} as {kinds[field.dataType.simpleString()]}) as {field.name}")
    return columns


def _raw(table: str) -> str:
    return f"select {', '.join(_raw_columns(table))} from {table}"


def _conversion(table: str) -> str:
    size = " + ".join(
        f"length(coalesce(cast({field.name} as varchar), ''))" for field in RAW_SCHEMAS[table]
    )
    return (
        f"select '{table}' as table_name, count(*) as n_rows, cast(sum({size}) as bigint) "
        f"as n_chars from ({_raw(table)})"
    )


def _rounded_merge(where: str = "true") -> str:
    return (
        f"select tconst, round(averageRating, {DIGITS}) as averageRating, numVotes "
        f"from merged where {where}"
    )


FOLD = f"""
    select coalesce(r.tconst, a.tconst) as tconst,
           round(case when dn is null then cast(averageRating as double)
                 else (coalesce(cast(averageRating as double) * numVotes, 0) + ds)
                      / (coalesce(numVotes, 0) + dn) end, {DIGITS}) as averageRating,
           cast(coalesce(numVotes, 0) + coalesce(dn, 0) as bigint) as numVotes
    from title_ratings r full outer join vote_totals a on r.tconst = a.tconst"""

SELECTS = {
    "scan_names": _raw("name_basics"),
    "scan_akas": _raw("title_akas"),
    "scan_crew": _raw("title_crew"),
    "scan_episodes": _raw("title_episode"),
    "scan_principals": _raw("title_principals"),
    "scan_ratings": _raw("title_ratings"),
    "tsv_roundtrip_ratings": _raw("title_ratings"),
    "tsv_roundtrip_basics": _raw("title_basics"),
    "parquet_conversion": " union all ".join(_conversion(table) for table in COPIED_TABLES),
    "partitioned_titles": "select * from title_basics",
    "result_json": """
        select cast(to_json(struct_pack(decade := decade, genre := genre, count := count))
                    as varchar) as json
        from genre_by_decade""",
    "preview_names": "select nconst, primaryName from name_basics order by nconst limit 10",
    "preview_akas": "select title, region from title_akas order by titleId limit 10",
    "rating_by_id": f"select * from title_ratings where tconst = '{TITLE_ID}' limit 1",
    "rating_by_id_bloom": f"select * from title_ratings where tconst = '{TITLE_ID}' limit 1",
    "genre_by_decade": "select * from genre_by_decade",
    "votes_by_title_type": "select * from votes_by_title_type",
    "snapshot_report": "select * from votes_by_title_type",
    "top_directors": "select * from top_directors",
    "director_records": """
        select primaryName as director, averageRating, movieCount, weightedScore
        from top_directors""",
    "director_labels": f"""
        select primaryName as director, {_two_decimals("averageRating")} as average_label,
               movieCount, {_two_decimals("weightedScore")} as score_label
        from top_directors""",
    "title_type_labels": """
        select titleType, format('{:,}', totalVotes) as votes_label from votes_by_title_type""",
    "movie_titles": "select * from movie_titles",
    "director_explode": """
        select tconst, unnest(string_split(directors, ',')) as director
        from title_crew where directors is not null""",
    "crew_ratings": "select * from crew_ratings",
    "movie_crew_ratings": "select * from movie_crew_ratings",
    "bucketed_movie_crew_ratings": "select * from movie_crew_ratings",
    "bucketed_rating_by_id": f"select * from title_ratings where tconst = '{TITLE_ID}' limit 1",
    "director_titles": "select * from director_titles",
    "director_avg": "select primaryName, averageRating, movieCount from weighted_scores",
    "weighted_scores": "select * from weighted_scores",
    "votes_parsed": "select msg_offset, tconst, vote from votes_parsed",
    "votes_rejected": """
        select msg_offset, value from vote_messages
        where msg_offset not in (select msg_offset from votes_parsed)""",
    "vote_log": "select * from votes",
    "vote_records_json": """
        select '{"row_key":"' || tconst || '_' || ts_ms || '","data":{"cf:vote":"' || vote
               || '"}}' as json
        from votes""",
    "vote_latest": "select * from vote_latest",
    "vote_range_scan": f"""
        select * from (select tconst || '_' || ts_ms as row_key, vote from votes)
        where row_key >= '{TITLE_ID}' and contains(row_key, '{TITLE_ID}')""",
    "vote_snapshot_lookup": f"""
        select tconst || '_' || ts_ms as row_key, vote from votes where tconst = '{TITLE_ID}'""",
    "recent_votes": "select tconst, vote, ts_ms from votes order by ts_ms desc, tconst",
    "vote_key_parts": """
        select row_key, split_part(row_key, '_', 1) as tconst,
               try_cast(split_part(row_key, '_', 2) as bigint) as ts_ms
        from (select tconst || '_' || cast(ts_ms as varchar) as row_key from votes)""",
    "vote_count": "select count(*) as n from votes",
    "vote_totals": "select * from vote_totals",
    "stored_vote_totals": """
        select tconst, count(*) as dn, cast(sum(vote) as bigint) as ds
        from vote_latest group by all""",
    "vote_messages_encode": """
        select '"' || tconst || '_' || cast(vote as varchar) || '"' as value
        from votes where tconst <> '' and vote between 1 and 5""",
    "merged_ratings": _rounded_merge(),
    "merged_rating_by_id": _rounded_merge(f"tconst = '{TITLE_ID}'"),
    "merged_ratings_contains": f"""
        with keyed as (select tconst || '_' || ts_ms as row_key, vote from votes),
        matched as (
            select r.tconst, count(*) as dn, sum(vote) as ds
            from title_ratings r join keyed
                 on row_key >= r.tconst and contains(row_key, r.tconst)
            group by r.tconst)
        select r.tconst,
               round(case when dn is null then cast(averageRating as double)
                     else (cast(averageRating as double) * numVotes + ds) / (numVotes + dn)
                     end, {DIGITS}) as averageRating,
               cast(numVotes + coalesce(dn, 0) as bigint) as numVotes
        from title_ratings r left join matched m on r.tconst = m.tconst""",
    "ratings_fold": FOLD,
    "ratings_display": f"""
        select tconst, {_two_decimals("averageRating")} as rating,
               format('{{:,}}', numVotes) as votes
        from merged""",
    "vote_stream_parsed": "select * from votes",
    "vote_stream_rejected": """
        select msg_offset, epoch_us(ts) // 1000 as ts_ms, value from vote_messages
        where msg_offset not in (select msg_offset from votes_parsed)""",
    "vote_stream_totals": "select * from vote_totals",
    "vote_stream_stored_totals": """
        select tconst, count(*) as dn, cast(sum(vote) as bigint) as ds
        from vote_latest group by all""",
    "vote_stream_state_totals": "select * from vote_totals",
    "vote_stream_changes": "select * from vote_totals",
    "vote_stream_merged": _rounded_merge("dn is not null"),
    "vote_stream_fold": FOLD,
    "vote_stream_range_fold": FOLD,
    "genre_list": "select distinct genre from genre_by_decade",
    "decade_list": "select * from decade_list",
    "decade_ticks": """
        select decade from (select decade, row_number() over (order by decade) as n
                            from decade_list) where n % 2 = 1""",
    "genre_series": """
        select genre, string_agg(decade || ':' || count, ',' order by decade) as points
        from genre_by_decade group by genre""",
    "genre_series_one": f"select decade, count from genre_by_decade where genre = '{GENRE}'",
    "axis_maxima": """
        select 'count' as axis, cast(max(count) as double) as maximum from genre_by_decade
        union all
        select 'totalVotes', cast(max(totalVotes) as double) from votes_by_title_type
        union all
        select 'weightedScore', max(weightedScore) from top_directors""",
}

ORACLES: dict[str, str] = {name: _with_views(select) for name, select in SELECTS.items()}
