"""DuckDB SQL for the queries that SQL can express, written from their contracts.

Not here: what a trained model decides (toxicity, secrets, page text, language
model), keyed surrogates, and periodic runs, which would take a join of words with words.
"""

from __future__ import annotations

from parcelyard.llm import chat, decontaminate, licenses, metric_join, mixing, near_dup, ranked
from parcelyard.llm.text import UPPER


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}')"


def _plain_words(text: str) -> str:
    return rf"regexp_extract_all({_lower(text)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _blank_words(text: str) -> str:
    return rf"regexp_extract_all({_lower(text)}, '[^\x20\x09-\x0D]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(map(_quoted, words)) + "]"


def _licenses() -> str:
    def rows(templates: tuple) -> str:
        return ", ".join(
            f"({_quoted(t.label)}, {_list(t.words)}, cast({t.share} as double))" for t in templates
        )

    tile, block = licenses.TILE, licenses.BLOCK
    return f"""
    with d as (
        select row_number() over () as row, doc_id, {_plain_words("text")} as words from documents
    ),
    phrases(label, phrase, share) as (values {rows(licenses.PHRASES)}),
    notices(label, phrase, share) as (values {rows(licenses.NOTICES)}),
    places as (
        select row, label, place - 1 as place from (
            select row, words, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from d
        ) join phrases on word = phrase[1] and words[place:place + len(phrase) - 1] = phrase
    ),
    blocks as (
        select row, words[spot * {tile} + 1:spot * {tile} + {block}] as block from (
            select row, words, unnest(range(0, (len(words) + {tile} - 1) // {tile})) as spot from d
        )
    ),
    met as (
        select row, label,
            len(list_intersect(list_distinct(phrase), block)) / len(list_distinct(phrase)) as part
        from blocks join notices on list_has_any(phrase, block)
            and len(list_intersect(list_distinct(phrase), block))
                >= ceil(share * len(list_distinct(phrase)) - 1e-9)
    ),
    labels as (
        select row, label, cast(1.0 as double) as part from places
        union all select row, label, part from met
    ),
    by_place as (
        select row, count(*) as n, min(place) as low, max(place) as high,
            array_to_string(list_sort(list(distinct label)), ',') as names
        from places group by row
    ),
    by_label as (
        select row, array_to_string(list_sort(list(distinct label)), ',') as names,
            max(part) as part
        from labels group by row
    )
    select doc_id, cast(len(words) as bigint) as n_words, coalesce(n, 0) as n_base,
        low as first_word, high as last_word, coalesce(by_place.names, '') as base_labels,
        coalesce(by_label.names, '') as labels, coalesce(part, 0.0) as score
    from d left join by_place using (row) left join by_label using (row)
    """


def _near_dup() -> str:
    size, percent = near_dup.SHINGLE, near_dup.PERCENT
    return f"""
    with recursive d as (
        select doc_id, {_blank_words("text")} as words from documents
    ),
    s as (
        select distinct doc_id, unnest(
            [array_to_string(words[spot:spot + {size - 1}], ' ')
             for spot in range(1, greatest(len(words) - {size - 2}, 2))]
        ) as shingle
        from d where len(words) > 0
    ),
    sizes as (select doc_id, count(*) as n from s group by doc_id),
    common as (
        select a.doc_id as a, b.doc_id as b, count(*) as shared
        from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id
        group by all
    ),
    links as (
        select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
        where 100 * shared >= {percent} * (x.n + y.n - shared)
    ),
    ways as (select a, b from links union all select b, a from links),
    reached(doc_id, other) as (
        select doc_id, doc_id from d
        union select reached.doc_id, ways.b from reached join ways on ways.a = reached.other
    )
    select doc_id, coalesce(n, 0) as n_shingles, min(other) as component_id,
        doc_id = min(other) as kept
    from reached left join sizes using (doc_id) group by doc_id, n
    """


def _chat() -> str:
    template = chat.INSTRUCT
    control = "(" + "|".join(
        "".join("\\" + c if c in "[]/<>" else c for c in s) for s in template.control
    ).replace("\\<", "<").replace("\\>", ">").replace("\\/", "/") + ")"

    def escaped(column: str) -> str:
        return rf"regexp_replace({column}, '(\\*){control}', '\1\1\\\2', 'g')"

    marks = " ".join(
        f"when role = {_quoted(name)} then {len(mark.opening) + len(mark.closing) + 3}"
        for name, mark in template.marks.items()
    )
    other = len(template.other.opening) + len(template.other.closing) + len(template.name_end) + 5
    learned = ", ".join(_quoted(n) for n, m in template.marks.items() if m.loss)
    steps = " or ".join(
        f"(state = {_quoted(a)} and role = {_quoted(b)})" for a, b in template.order
    )
    ends = ", ".join(map(_quoted, template.ends))
    text = "</s>[INST] ok [/INST]"
    order = "turn nulls first, role, text"
    return f"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
        from conversations
        union all values (-7, 0, 'user', '{text}'), (-7, 1, 'assistant', '{text}')
    ),
    placed as (
        select *, coalesce(lag(role) over (partition by conv_id order by {order}), 'start') as state,
            lead(role) over (partition by conv_id order by {order}) is null as last,
            len({escaped("text")}) + case {marks} else {other} + len({escaped("role")}) end as chars
        from turns
    )
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by {order})) as turns_sha256,
        cast(coalesce(sum(len(text)) filter (role in ({learned})), 0) as bigint) as loss_chars,
        sha256(coalesce(string_agg(text, '' order by {order}) filter (role in ({learned})), ''))
            as loss_sha256,
        cast(sum(chars) as bigint) as formatted_chars,
        bool_and({steps}) and bool_or(last and role in ({ends})) as in_order
    from placed group by conv_id
    """


def _near_vectors() -> str:
    return f"""
    with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings),
    able as (
        select * from v where label is not null and vec_id is not null and e is not null
            and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
            and len(list_filter(e, lambda x: x != 0)) > 0
    ),
    ways as (
        select a.vec_id as a, b.vec_id as b from able a join able b
        on a.label = b.label and a.vec_id != b.vec_id and len(a.e) = len(b.e)
        where list_cosine_similarity(a.e, b.e) >= {metric_join.COSINE}
    ),
    counts as (select a, count(*) as n from ways group by a),
    reached(vec_id, other) as (
        select vec_id, vec_id from v
        union select reached.vec_id, ways.b from reached join ways on ways.a = reached.other
    )
    select vec_id, coalesce(n, 0) as n_links, min(other) as component_id,
        vec_id = min(other) as kept
    from reached left join counts on a = vec_id group by vec_id, n
    """


def _decontaminate() -> str:
    window = decontaminate.WINDOW
    return f"""
    with d as (
        select row_number() over () as row, doc_id, {_plain_words("text")} as words from documents
    ),
    b as (select cast(item_id as varchar) as item, {_plain_words("text")} as words from benchmark),
    windows as (
        select distinct item, unnest(
            [words[spot:spot + {window - 1}] for spot in range(1, greatest(len(words) - {window - 2}, 2))]
        ) as part
        from b where len(words) > 0
    ),
    phrases as (select item, len(part) as n, array_to_string(part, ' ') as phrase from windows),
    spans as (
        select row, spot, n, array_to_string(words[spot:spot + n - 1], ' ') as phrase from (
            select row, words, n, unnest(range(1, len(words) - n + 2)) as spot
            from d join (select distinct n from phrases) on len(words) >= n
        )
    ),
    found as (select row, spot, n, item from spans join phrases using (n, phrase)),
    hit as (
        select row, count(distinct place) as n_hit from (
            select row, unnest(range(spot, spot + n)) as place from (select distinct row, spot, n from found)
        ) group by row
    ),
    items as (
        select row, count(distinct item) as n_items,
            array_to_string(list_sort(list(distinct item)), ',') as names
        from found group by row
    )
    select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
        coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256,
        n_hit is not null as contaminated
    from d left join hit using (row) left join items using (row)
    """


def _mix() -> str:
    weights = "[" + ", ".join(f"cast({w} as double)" for w in mixing.WEIGHTS) + "]"
    most = mixing.REPEATS
    return f"""
    with d as (
        select doc_id, source, cast(len({_blank_words("text")}) as bigint) as size,
            md5(coalesce(cast(doc_id as varchar), '')) as key
        from documents
    ),
    totals as (
        select source, cast(sum(size) as bigint) as source_size,
            {weights}[(row_number() over (order by source nulls last) - 1) % {len(mixing.WEIGHTS)} + 1]
                as weight
        from d group by source
    ),
    -- Sources are held at their most in the order in which they reach it.
    held as (
        select *, {most} * source_size / weight as reach,
            sum(source_size) over () - coalesce(sum({most} * source_size) over earlier, 0) as rest,
            sum(weight) over () - coalesce(sum(weight) over earlier, 0) as open
        from totals
        window earlier as (
            order by {most} * source_size / weight, source nulls last
            rows between unbounded preceding and 1 preceding
        )
    ),
    level as (select arg_min(rest / open, reach) filter (rest / open <= reach) as level from held),
    targets as (
        select source, source_size, least(weight * level, cast({most} * source_size as double)) as target
        from totals, level
    ),
    placed as (
        select doc_id, size, source_size, target,
            least(cast(round(target) as bigint), {most} * source_size) as quota,
            sum(size) over (
                partition by d.source order by key, doc_id nulls first, size
                rows between unbounded preceding and current row
            ) - size as start
        from d join targets on d.source is not distinct from targets.source
    )
    select doc_id, size, source_size, target, cast(list_sum(
        [greatest(0, least(turn * source_size + start + size, quota) - turn * source_size - start)
         for turn in range({most})]
    ) as bigint) as taken
    from placed
    """


def _ranked() -> str:
    terms = _plain_words("text")
    return f"""
    with d as (
        select row_number() over () as row, doc_id, {terms} as words from documents
    ),
    -- All of the collection: documents with a term, and their terms with repeats.
    whole as (
        select count(*) filter (len(words) > 0) as n, cast(sum(len(words)) as bigint) as length from d
    ),
    counts as (
        select row, term, count(*) as tf from (select row, unnest(words) as term from d) group by all
    ),
    rare as (select term, count(*) as df from counts group by term),
    weighed as (
        select term, cast(floor(
            {ranked.WEIGHT} * ln(cast(2 * n + 2 as double) / cast(2 * df + 1 as double))
        ) as bigint) as weight
        from rare, whole
    ),
    sizes as (
        select row, doc_id,
            {100 - ranked.LENGTH} + ({ranked.LENGTH} * cast(len(words) as bigint) * n) // length as m
        from d, whole where len(words) > 0
    ),
    wanted as (
        select distinct item_id, term
        from (select item_id, unnest({terms}) as term from benchmark)
    ),
    scored as (
        select item_id, doc_id, row, cast(sum(
            weight * (({ranked.PART} * tf) // (1000 * tf + {ranked.SATURATION} * m))
        ) as bigint) as score
        from wanted join counts using (term) join weighed using (term) join sizes using (row)
        group by item_id, doc_id, row
    ),
    ordered as (
        select item_id, doc_id, score, cast(row_number() over (
            partition by item_id order by score desc, doc_id
        ) as integer) as rank
        from scored where score > 0
    )
    select item_id, rank, doc_id, score from ordered where rank <= {ranked.TOP}
    """


QUERIES: dict[str, str] = {
    "op1_licenses": _licenses(),
    "op3_near_dup": _near_dup(),
    "op4_chat": _chat(),
    "op7_near_vectors": _near_vectors(),
    "op8_decontaminate": _decontaminate(),
    "op9_mix": _mix(),
    "op11_ranked_search": _ranked(),
}
