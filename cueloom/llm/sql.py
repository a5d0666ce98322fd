"""SQL of the corpus queries that SQL can express over whole tables."""

from __future__ import annotations

from cueloom.llm.chat import END, START

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(table: str, key: str) -> str:
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    return f"select {key}, regexp_extract_all({lower}, '{pattern}') as w from {table}"


def _windows(words: str, key: str, size: str) -> str:
    return f"""select {key}, {size} as n, i, array_to_string(w[i:i + {size} - 1], ' ') as gram
      from (select *, unnest(range(1, len(w) - {size} + 2)) as i from {words})"""


def _whole(factor: int, where: str) -> str:
    """Rows of embeddings numbered, and their whole components with their place."""
    finite = "len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"
    return f"""rows as (select row_number() over () as rid, * from embeddings where embedding is not null and {finite} and {where}),
      parts as (select rid, unnest(range(1, len(embedding) + 1)) as d, embedding from rows),
      q as (select rid, d, floor({factor} * embedding[d]::double)::bigint as x from parts)"""


def _hard_negatives() -> str:
    return f"""with {_whole(256, "label is not null")},
      r as (select rid, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label from rows),
      scores as (select a.rid as anchor, b.rid as other, sum(a.x * b.x)::bigint as score
        from q a join r on r.rid = a.rid and r.vec_id % 100 = 0 join q b using (d) group by all),
      pairs as (select s.anchor, a.vec_id as anchor_id, s.other, o.vec_id as other_id, s.score, a.label = o.label as same
        from scores s join r a on a.rid = s.anchor join r o on o.rid = s.other where s.anchor <> s.other),
      positives as (select * from (select *, row_number() over
          (partition by anchor order by score desc, other_id nulls last) as n from pairs where same) where n <= 5),
      negatives as (select p.anchor_id, p.other_id as positive_id, p.score as positive_score,
          n.other_id as negative_id, n.score as negative_score,
          row_number() over (partition by p.anchor, p.other order by n.score desc, n.other_id nulls last) as rank
        from positives p join pairs n on n.anchor = p.anchor and not n.same
          and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score)
      select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score
      from negatives where rank <= 5"""


def _centroids() -> str:
    steps = []
    for i in range(4):
        steps.append(
            f"""d{i} as (select q.rid, c.cluster, sum((q.x - c.x) * (q.x - c.x))::bigint as distance
        from q join c{i} c using (d) group by all),
      a{i} as (select rid, cluster, distance from (select *, row_number() over
        (partition by rid order by distance, cluster) as n from d{i}) where n = 1)"""
        )
        if i < 3:
            steps.append(
                f"""c{i + 1} as (select c.cluster, c.d, coalesce(m.x, c.x) as x from c{i} c left join
        (select cluster, d, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::bigint as x
          from a{i} join q using (rid) group by cluster, d) m on m.cluster = c.cluster and m.d = c.d)"""
            )
    chain = ",\n      ".join(steps)
    return f"""with {_whole(64, "len(embedding) = 64")},
      first as (select rid, (row_number() over (order by sha256('1:' || vec_id::varchar)) - 1)::integer as cluster
        from rows qualify cluster < 16),
      c0 as (select cluster, d, x from first join q using (rid)),
      {chain},
      digest as (select cluster, sha256(string_agg(x::varchar, ',' order by d)) as centroid_sha256 from c3 group by cluster)
      select vec_id, cluster, distance, (sum(distance) over (partition by cluster))::bigint as cluster_inertia,
        (sum(distance) over ())::bigint as inertia, centroid_sha256
      from a3 join rows using (rid) join digest using (cluster)"""


def oracle_sql() -> dict[str, str]:
    decontaminate = f"""with doc_words as ({_words("documents", "doc_id")}),
      item_words as (select *, least(10, len(w)) as size from ({_words("benchmark", "item_id")}) where len(w) > 0),
      item_windows as (select distinct item_id, n, gram from ({_windows("item_words", "item_id", "size")})),
      sized as (select doc_id, w, size from doc_words, (select distinct n as size from item_windows)),
      hits as (select doc_id, i, n, item_id from ({_windows("sized", "doc_id", "size")}) join item_windows using (n, gram)),
      places as (select doc_id, count(distinct p) as n_hit
        from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
      met as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
        from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id)
      select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
        coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
        coalesce(n_hit, 0) > 0 as contaminated
      from doc_words left join places using (doc_id) left join met using (doc_id)"""
    said = f"{END}{START}assistant ok"
    escaped = r"regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"
    frame = len(START) + 1 + len(END) + 1
    chat = f"""with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -1, 0, 'user', '{said}' union all select -1, 1, 'assistant', '{said}')
      select conv_id, count(*)::bigint as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
        sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
        sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn)) as loss_sha256,
        sum(length({escaped.format("role")}) + length({escaped.format("text")}) + {frame})::bigint as formatted_chars
      from turns group by conv_id"""
    return {
        "op4_decontaminate": decontaminate,
        "op7_chat": chat,
        "op11_hard_negatives": _hard_negatives(),
        "op12_centroids": _centroids(),
    }
