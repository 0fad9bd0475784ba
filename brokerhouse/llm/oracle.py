"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

# crc32 of an ASCII text, bit by bit
_CRC32 = """xor(list_reduce(
    list_transform(range(length({0})), lambda i: cast(ord(substr({0}, cast(i + 1 as integer), 1)) as bigint)),
    lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
        lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(c, b)),
    cast(4294967295 as bigint)), 4294967295)"""


def _state(state: str, cost: str, initial: str, turn: str = "''") -> str:
    """A state's cost, audit and turns after one more edit."""
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{initial}', 't': {state}.t || {turn}}}"


def _kept(state: str, initial: str) -> str:
    return _state(state, f"case when fault in (0, 3) and initial = '{initial}' then late else 1000000 end", "K", "chr(10) || role || ':' || text")


def _put(state: str, role: str) -> str:
    return _state(state, "case when fault in (0, 3) then 2 + late else 1000000 end", "R", f"chr(10) || '{role}:' || text")


def _inserted(state: str, role: str) -> str:
    return _state(state, "2", "I", f"chr(10) || '{role}:'")


_REPAIR = f"""
    with recursive
    source as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
            coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k
        from conversations
    ),
    kinds as (select *, {_CRC32.format("k")} % 20 as kind from source),
    damaged as (
        select conv_id, turn, case when kind = 4 then 'user' else role end as role,
            case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
            unnest(case when kind = 3 then [0, 1] else [0] end) as copy
        from kinds where kind <> 0
    ),
    numbered as (
        select *, substr(role, 1, 1) as initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare,
            row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as n
        from damaged
    ),
    marked as (
        select *,
            case when bare = '' then 1
                when row_number() over (partition by conv_id, role, text order by n) > 1 then 2
                when right(bare, 1) not in ('.', '!', '?') then 3 else 0 end as fault,
            lag(initial) over (partition by conv_id order by n) || initial as pair
        from numbered
    ),
    rows_ as (select *, cast(fault = 3 as integer) as late from marked),
    steps as (
        select conv_id, cast(0 as bigint) as n, {{'c': 0, 'a': '', 't': ''}} as q0, {{'c': 1000000, 'a': '', 't': ''}} as qs,
            {{'c': 2, 'a': 'I', 't': chr(10) || 'user:'}} as qu,
            {{'c': 4, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} as qa
        from (select distinct conv_id from rows_)
        union all
        select conv_id, n, q0, qs, qu, least(na, {_inserted("qu", "assistant")}) as qa from (
            select conv_id, n, q0, qs, na,
                least(nu, {_inserted("q0", "user")}, {_inserted("qs", "user")}, {_inserted("na", "user")}) as qu
            from (
                select s.conv_id, r.n, {_state("q0", "3", "D")} as q0,
                    least({_state("qs", "3", "D")}, {_kept("q0", "s")}) as qs,
                    least({_state("qu", "3", "D")}, {_kept("q0", "u")}, {_kept("qs", "u")}, {_kept("qa", "u")},
                        {_put("q0", "user")}, {_put("qs", "user")}, {_put("qa", "user")}) as nu,
                    least({_state("qa", "3", "D")}, {_kept("qu", "a")}, {_put("qu", "assistant")}) as na
                from steps s join rows_ r on s.conv_id = r.conv_id and r.n = s.n + 1
            )
        )
    ),
    best as (
        select conv_id, least(q0, qa) as b from steps
        qualify row_number() over (partition by conv_id order by n desc) = 1
    ),
    counts as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(fault = 1) as blank,
            count_if(fault = 2) as duplicate, count_if(fault = 3) as truncated,
            count_if(pair not in ('su', 'ua', 'au')) as illegal
        from rows_ group by conv_id
    )
    select i.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, cast(coalesce(blank, 0) as bigint) as blank,
        cast(coalesce(duplicate, 0) as bigint) as duplicate, cast(coalesce(truncated, 0) as bigint) as truncated,
        cast(coalesce(illegal, 0) as bigint) as illegal, cast(coalesce(b.c, 0) as bigint) as cost, coalesce(b.a, '') as audit,
        sha256(coalesce(substr(b.t, 2), '')) as repaired_sha256
    from (select distinct conv_id from conversations) i left join counts using (conv_id) left join best using (conv_id)
"""


def _near_classes(percent: int, kept: str) -> str:
    """Sets of shingles of three words, links by Jaccard similarity, and the least id of each component."""
    return f"""
        with recursive
        words as (
            select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents
        ),
        runs as (
            select doc_id, unnest(
                case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as run
            from words
        ),
        shingles as (select distinct doc_id, md5_number(run) as run from runs),
        sizes as (select doc_id, count(*) as n from shingles group by doc_id),
        shared as (
            select a.doc_id as a, b.doc_id as b, count(*) as m
            from shingles a join shingles b on a.run = b.run and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id
        ),
        links as (
            select a, b from shared join sizes x on a = x.doc_id join sizes y on b = y.doc_id
            where 100 * m >= {percent} * (x.n + y.n - m)
        ),
        reach as (
            select distinct a as doc_id, a as other from links
            union
            select reach.doc_id, links.b from reach join links on reach.other = links.a
        ),
        least as (select doc_id, min(other) as least from reach group by doc_id)
        select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, coalesce(least, doc_id) as component_id{kept}
        from (select doc_id from documents) left join sizes using (doc_id) left join least using (doc_id)
    """


_TAG = """'"' || substr(digest, 1, 12) || '-' || (page_id + {0} + 2) // 2 || '"'"""
_REVISITS = f"""
    with page as (select page_id, url, md5(coalesce(html, '')) as digest, length(coalesce(html, '')) as size from pages),
    full_ as (
        select page_id * 16 + c as id, url, 1700000000 + page_id * 60 + c * 172800 as t,
            case when page_id % 5 <> 1 then {_TAG.format("c")} end as etag,
            cast(1700000000 + (page_id + c + 2) // 2 * 1000 as varchar) as modified, size + c as size,
            case when (page_id + c) % 2 = 1 then digest || '-' || (page_id + c + 2) // 2 end as digest
        from page, range(3) r(c)
    ),
    again as (
        select page_id * 16 + 8 + c as id, replace(regexp_replace(url, '#.*$', ''), 'http', 'HTTP') || '#again' as url,
            1700000000 + page_id * 60 + c * 172800 - 3600 as t, page_id % 100 as age,
            case (page_id + c) % 6 when 1 then 'W/' || {_TAG.format("c - 1")} when 0 then '"other"' when 4 then '"other"' end as etag,
            case when (page_id + c) % 6 in (2, 4) then cast(1700000000 + (page_id + c + 1) // 2 * 1000 as varchar)
                when (page_id + c) % 6 = 5 then '0' end as modified,
            case when (page_id + c) % 6 = 0 then digest || '-' || (page_id + c + 1) // 2 end as digest
        from page, range(4) r(c)
    ),
    parts as (
        select id, regexp_extract(regexp_replace(trim(url), '#.*$', ''), '^([A-Za-z][A-Za-z0-9+.\\-]*)://(?:[^/?]*@)?([^/?]*)([^?]*)\\??(.*)$',
            ['scheme', 'host', 'path', 'query']) as u
        from (select id, url from full_ union all select id, url from again)
    ),
    known as (
        select id, lower(u.scheme) || '://' || regexp_replace(lower(u.host), case when lower(u.scheme) = 'http' then ':80$' else ':443$' end, '')
            || case when u.path = '' then '/' else u.path end
            || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(u.query, '&'), lambda p: p <> '')), '&'), ''), '') as url
        from parts
    ),
    met as (
        select a.id, max_by(f, {{'t': f.t, 'id': f.id}}) as f
        from again a join known ka on a.id = ka.id join known kf on ka.url = kf.url
            join full_ f on kf.id = f.id and f.t < a.t
        group by a.id
    ),
    judged as (
        select a.*, k.url as place, f, coalesce(
            case when a.digest is not null and f.digest is not null then a.digest = f.digest end,
            case when a.etag is not null and f.etag is not null then regexp_replace(a.etag, '^W/', '') = regexp_replace(f.etag, '^W/', '') end,
            case when a.modified is not null and f.modified is not null then a.modified = f.modified end) as agrees
        from again a join known k on a.id = k.id left join met on a.id = met.id
    )
    select id as record_id, place as url, case when agrees then f.id end as original_id,
        case when f is null then 'no_original' when agrees is null then 'no_validator' when agrees then 'resolved'
            else 'validator_mismatch' end as outcome,
        case when agrees then f.digest else digest end as payload_digest,
        case when agrees then coalesce(etag, f.etag) else etag end as etag,
        case when agrees then f.modified else modified end as last_modified, cast(t as varchar) as date,
        'max-age=' || age as cache_control, case when agrees then 'text/html' end as content_type,
        case when agrees then cast(f.size as varchar) end as content_length, case when agrees then null else 'edge' end as server
    from judged
"""

ORACLE_SQL: dict[str, str] = {
    "op8_exact_dedup": f"""
        with texts as (select doc_id, {_LOWER} as t from documents),
        groups as (select t, max(doc_id) as keep_id, count(*) as group_size from texts group by t)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256
        from texts join groups using (t)
    """,
    "op3_revisits": _REVISITS,
    "op7_ngram_join": _near_classes(90, ""),
    "op12_minhash_dedup": _near_classes(85, ", doc_id = coalesce(least, doc_id) as kept"),
    "op11_hard_negatives": """
        with v as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
            from embeddings where embedding is not null and label is not null
        ),
        scored as (
            select a.vec_id as anchor_id, c.vec_id as other_id, a.label = c.label as same,
                cast(list_inner_product(a.e, c.e) as bigint) as score
            from v a join v c on a.vec_id % 50 = 0 and a.vec_id <> c.vec_id
        ),
        positives as (
            select *, row_number() over (partition by anchor_id order by score desc, other_id) as r from scored where same
        ),
        negatives as (
            select p.anchor_id, p.other_id as positive_id, n.other_id as negative_id, p.score as positive_score,
                n.score as negative_score,
                row_number() over (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id) as r
            from positives p join scored n on p.r <= 5 and p.anchor_id = n.anchor_id and not n.same
                and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
        )
        select anchor_id, positive_id, cast(r as integer) as rank, negative_id, positive_score, negative_score
        from negatives where r <= 3
    """,
    "op13_conversations": _REPAIR,
    "op9_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
            from embeddings where embedding is not null
        ),
        scored as (
            select q.vec_id as query_id, c.vec_id as vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
            from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
        ),
        ranked as (
            select *, row_number() over (partition by query_id order by score desc, vec_id) as r from scored
        )
        select query_id, cast(r as integer) as rank, vec_id, score from ranked where r <= 5
    """,
}
