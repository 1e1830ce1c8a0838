"""DuckDB SQL of the registered queries. What is missing here is held against Python in the tests."""

_TOK = r"""tok AS (SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS text
    FROM (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda x: x <> '') AS t FROM documents))"""
_SENT = "[.!?][\"''’”)]?$"
_CLAUSE = "[,;:][\"''’”)]?$"
_TIMED = _TOK + rf""",
    spoken AS (SELECT doc_id, pos, text, (length(text) * 60 + 40) * (CASE WHEN doc_id % 5 = 0 THEN 3 ELSE 1 END) AS sp,
        CASE WHEN regexp_matches(text, '{_SENT}') THEN (CASE WHEN pos % 3 = 0 THEN 1200 ELSE 350 END) ELSE 0 END AS pa FROM tok),
    ms AS (SELECT doc_id, pos, text, sp, (sum(sp + pa) OVER (PARTITION BY doc_id ORDER BY pos) - sp - pa)::BIGINT AS start_ms FROM spoken),
    timed AS (SELECT doc_id, pos, text, start_ms, start_ms + sp AS end_ms, start_ms / 1000e0 AS "start", (start_ms + sp) / 1000e0 AS "end" FROM ms)"""
_LEX = r"list_filter(list_transform(string_split_regex({}, '\s+'), lambda x: regexp_replace(lower(x), '[^a-z0-9]+', '', 'g')), lambda x: x <> '')"
_CHUNKS = """turns AS (SELECT conv_id, role, coalesce(text, '') AS text, row_number() OVER w - 1 AS chunk_pos,
        sum(length(coalesce(text, '')) * 960 + 8000) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)::BIGINT AS end_frame,
        length(coalesce(text, '')) * 960 + 8000 AS size
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
    chunk AS (SELECT conv_id::VARCHAR AS book_id, conv_id, chunk_pos, chunk_pos // 4 AS chapter_id, 'Chapter ' || (chunk_pos // 4) AS chapter_title, chunk_pos % 4 + 1 AS part,
        end_frame - size AS start_frame, end_frame, text FROM turns)"""
_PAIRS = _CHUNKS + """,
    pair AS (SELECT *, text AS a_text, CASE WHEN (conv_id + chunk_pos) % 3 = 0 THEN translate(text, 'aeiou', 'AEIOU') ELSE following END AS b_text
        FROM (SELECT *, lead(text) OVER (PARTITION BY conv_id ORDER BY chunk_pos) AS following FROM chunk) WHERE following IS NOT NULL)"""
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_TIDY = (
    r"trim(regexp_replace(regexp_replace(regexp_replace({strip2}, '(?i)^({labels})\s*:\s*', ''), '([.!?][" + "\"''’”)" + r"]?)([A-Z])', '\1 \2', 'g'), '\s+', ' ', 'g'))"
)
_RAW = """raw AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '<think>plan</think> Corrected transcript: ' || coalesce(text, '')
        WHEN 1 THEN '<THINK>a' || chr(10) || 'b</THINK>`' || coalesce(text, '') || '`' WHEN 2 THEN '<think>never closed ' || coalesce(text, '')
        ELSE 'Final transcript: ' || coalesce(text, '') END AS raw FROM documents)"""


def _tidy(text: str, labels: str) -> str:
    inner = _STRIP.format(f"regexp_replace({_STRIP.format(text)}, '^`+|`+$', '', 'g')")
    return _TIDY.format(strip2=inner, labels=labels)


def _time(seconds: str, mark: str) -> str:
    ms = f"greatest(0, round_even({seconds} * 1000, 0)::BIGINT)"
    return f"printf('%02d:%02d:%02d{mark}%03d', {ms} // 3600000, {ms} // 60000 % 60, {ms} // 1000 % 60, {ms} % 1000)"


_ISLANDS = _TIMED + """,
    isl AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT AS island FROM (
        SELECT *, CASE WHEN "start" - lag("end") OVER (PARTITION BY doc_id ORDER BY pos) < 1e0 THEN 0 ELSE 1 END AS opens FROM timed))"""
_ANCHORS = _TIMED + """,
    cand AS (SELECT *, CASE WHEN pos % 17 <> 0 THEN (pos * 7919 + doc_id * 104729) % 901 - 450 + CASE WHEN pos % 11 = 0 THEN 4300 ELSE 0 END END AS off FROM timed),
    anc AS (SELECT doc_id, pos, off / 1000e0 AS delta, list_sort(list(off / 1000e0) FILTER (abs(off / 1000e0) <= 4e0) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING)) AS votes
        FROM cand WHERE off IS NOT NULL),
    acc AS (SELECT doc_id, pos, delta, votes[len(votes) // 2 + 1] AS median,
        coalesce(abs(delta) <= 4e0 AND abs(delta - votes[len(votes) // 2 + 1]) <= 0.8e0, false) AS accepted FROM anc)"""
_FUSED = _ANCHORS + """,
    j AS (SELECT c.doc_id, c.pos, accepted, "start" AS s, "end" AS e, (start_ms + off) / 1000e0 AS ws, (end_ms + off) / 1000e0 AS we FROM cand c LEFT JOIN acc USING (doc_id, pos)),
    f1 AS (SELECT doc_id, pos, accepted, round(max(CASE WHEN accepted THEN least(s, ws) ELSE s END) OVER (PARTITION BY doc_id ORDER BY pos), 3) AS ns,
        CASE WHEN accepted THEN greatest(e, we) ELSE e END AS x FROM j),
    f2 AS (SELECT *, greatest(round(x, 3), ns) AS wide, lead(ns) OVER (PARTITION BY doc_id ORDER BY pos) AS nx FROM f1),
    fused AS (SELECT doc_id, pos, accepted, ns AS new_start, round(least(wide, CASE WHEN nx > ns THEN least(ns + 1.5e0, nx) ELSE ns + 1.5e0 END), 3) AS new_end FROM f2)"""
# one row for each island and step; the open cue's text, start and end are carried, every word of an island is visited once
_CUES = "WITH RECURSIVE " + _ISLANDS + rf""",
    w AS (SELECT *, row_number() OVER (PARTITION BY doc_id, island ORDER BY pos) AS k FROM isl),
    walk AS (
        SELECT doc_id, island, k, pos, text AS word, "start" AS cs, "end" AS ce, text AS so, true AS opened FROM w WHERE k = 1
        UNION ALL
        SELECT doc_id, island, k, pos, word, CASE WHEN cut THEN ws ELSE cs END, we, CASE WHEN cut THEN word ELSE longer END, cut FROM (
            SELECT n.doc_id, n.island, n.k, n.pos, n.text AS word, n."start" AS ws, n."end" AS we, p.cs, p.so || ' ' || n.text AS longer,
                (n."start" - p.ce >= 1e0 OR length(p.so || ' ' || n.text) > 78
                 OR (length(p.so || ' ' || n.text) > 42 AND NOT coalesce(list_bool_or(list_transform(range(1, length(p.so || ' ' || n.text)), lambda i:
                        (p.so || ' ' || n.text)[i + 1] = ' ' AND i <= 42 AND length(p.so || ' ' || n.text) - i - 1 <= 42)), false))
                 OR (n."end" - p.cs > 6.5e0 AND p.ce - p.cs >= 1e0)
                 OR (regexp_matches(p.word, '{_SENT}') AND p.ce - p.cs >= 1e0 AND length(p.so) >= 20)
                 OR (regexp_matches(p.word, '{_CLAUSE}') AND p.ce - p.cs >= 3.5e0 AND length(p.so) >= 48)) AS cut
            FROM walk p JOIN w n ON n.doc_id = p.doc_id AND n.island = p.island AND n.k = p.k + 1)),
    numbered AS (SELECT doc_id, pos, sum(opened::INT) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT AS cue FROM walk),
    cues AS (SELECT doc_id, cue, arg_min("start", pos) AS "start", max("end") AS raw_end, count(*) AS n_words, string_agg(text, ' ' ORDER BY pos) AS text
        FROM numbered JOIN timed USING (doc_id, pos) GROUP BY doc_id, cue)"""
_TIMED_CUES = _CUES + """,
    nx AS (SELECT *, coalesce(lead("start") OVER (PARTITION BY doc_id ORDER BY cue), raw_end + 1e0) AS nxt FROM cues),
    tc AS (SELECT doc_id, cue, "start", text, greatest(CASE WHEN nxt > "start" + 0.08e0 THEN least(least(greatest(raw_end + 0.08e0, "start" + 0.8e0), "start" + 6.5e0), nxt - 0.04e0)
        ELSE least(raw_end, "start" + 6.5e0) END, "start" + 0.08e0) AS "end" FROM nx)"""
# the forward pass: s is the open cue's start, as the cue before may have moved it; done is the settled end of that cue
_REPAIRED = _TIMED_CUES + """,
    pass AS (
        SELECT doc_id, cue, "start" AS s, "end" AS e, NULL::DOUBLE AS done, text FROM tc WHERE cue = 1
        UNION ALL
        SELECT n.doc_id, n.cue, CASE WHEN p.e >= n."start" AND n."start" <= p.s THEN least(p.s + 6.5e0, greatest(p.e, p.s + 0.8e0)) + 0.04e0 ELSE n."start" END, n."end",
            CASE WHEN p.e < n."start" THEN p.e WHEN n."start" <= p.s THEN least(p.s + 6.5e0, greatest(p.e, p.s + 0.8e0)) ELSE greatest(p.s + 0.01e0, n."start" - 0.04e0) END, n.text
        FROM pass p JOIN tc n ON n.doc_id = p.doc_id AND n.cue = p.cue + 1),
    fixed AS (SELECT doc_id, cue, s AS "start", coalesce(lead(done) OVER (PARTITION BY doc_id ORDER BY cue), e) AS "end", text FROM pass),
    parts AS (SELECT *, list_filter(string_split(text, ' '), lambda x: x <> '') AS t FROM fixed),
    best AS (SELECT *, list_min(list_filter(list_transform(range(1, len(t)), lambda i: struct_pack(
            score := greatest(length(array_to_string(t[:i], ' ')), length(array_to_string(t[i + 1:], ' '))) + abs(length(array_to_string(t[:i], ' ')) - length(array_to_string(t[i + 1:], ' '))) * 0.2e0,
            a := array_to_string(t[:i], ' '), b := array_to_string(t[i + 1:], ' '))), lambda x: length(x.a) <= 42 AND length(x.b) <= 42)) AS best FROM parts),
    final AS (SELECT doc_id, cue, "start", "end", CASE WHEN length(text) <= 42 OR best IS NULL THEN text ELSE best.a || chr(10) || best.b END AS text FROM best)"""

# the planner's rule for one chunk, as an expression in b (its first frame) and n (the chapter's frames); 100 frames a second, windows of five
_SAMPLE = "((((start_frame + {i}) * 7919 + k * 31) % 1000) / 1000e0)::FLOAT::DOUBLE"
_LOUD = f"list_transform(range((least(b + 24000, b + 27000, n - 6000) - b - 18000) // 5), lambda w: sqrt(list_sum(list_transform(range(5), lambda j: power({_SAMPLE.format(i='b + 18000 + 5 * w + j')}, 2))) / 5 + 1e-12))"
_QUIET = """list_transform([{loud}], lambda l: list_transform([struct_pack(l := l, t := list_aggregate(l, 'quantile_cont', 0.08))], lambda s: list_sort(list_transform(
    list_filter(range(len(s.l)), lambda w: s.l[w + 1] <= s.t), lambda w: struct_pack(d := abs(w - 600), w := w)))[1].w)[1])[1]""".format(loud=_LOUD)
_END = f"CASE WHEN n - b <= 27000 THEN n WHEN least(b + 24000, n - 6000) - b - 18000 < 10 THEN b + 21000 ELSE b + 18000 + 5 * ({_QUIET}) + 2 END"
_PLANNER = f"""WITH RECURSIVE ch AS (
        SELECT n_name AS book_id, n_nationkey::BIGINT AS k, 0::BIGINT AS chapter_id, 'Preface' AS chapter_title, 0::BIGINT AS start_frame, 5001::BIGINT AS n FROM nation
        UNION ALL SELECT n_name, n_nationkey, 1, 'The rest', 5001, n_nationkey * 4000 + 20000 - 5001 FROM nation),
    walk AS (SELECT *, 1::BIGINT AS part, 0::BIGINT AS a, ({_END})::BIGINT AS e FROM (SELECT *, 0::BIGINT AS b FROM ch)
        UNION ALL SELECT book_id, k, chapter_id, chapter_title, start_frame, n, b, part, a, ({_END})::BIGINT
            FROM (SELECT book_id, k, chapter_id, chapter_title, start_frame, n, e AS b, part + 1 AS part, e AS a FROM walk WHERE e < n))
    SELECT book_id, printf('c%02d_p%02d', chapter_id, part) AS id, chapter_id, chapter_title, part, start_frame + a AS start_frame, start_frame + e AS end_frame,
        round((start_frame + a) / 100, 3) AS "start", round((start_frame + e) / 100, 3) AS "end", round((e - a) / 100, 3) AS duration FROM walk"""

ORACLES: dict[str, str] = {
    "lexical_counts": rf"""SELECT doc_id, len(list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda x: x <> ''))::BIGINT AS tokens,
        len({_LEX.format("coalesce(text, '')")})::BIGINT AS lexical_words FROM documents""",
    "token_normalise": f"WITH {_TOK} SELECT regexp_replace(lower(text), '[^a-z0-9]+', '', 'g') AS norm, count(*) AS n FROM tok GROUP BY 1",
    "clean_generation_local": f"WITH {_RAW} SELECT doc_id, {_tidy(chr(40) + 'regexp_replace(raw, ' + chr(39) + '(?is)<think>.*?</think>' + chr(39) + ', ' + chr(39) * 2 + ', ' + chr(39) + 'g' + chr(39) + '))', 'corrected transcript|transcript')} AS cleaned FROM raw",
    "clean_generation_remote": f"WITH {_RAW} SELECT doc_id, {_tidy('(CASE WHEN contains(raw, ' + chr(39) + '</think>' + chr(39) + ') THEN string_split(raw, ' + chr(39) + '</think>' + chr(39) + ')[-1] WHEN contains(raw, ' + chr(39) + '<think>' + chr(39) + ') THEN ' + chr(39) * 2 + ' ELSE raw END)', 'final transcript|corrected transcript|transcript')} AS cleaned FROM raw",
    "sentence_clause_flags": f"WITH {_TOK} SELECT doc_id, count(*) FILTER (regexp_matches(text, '{_SENT}')) AS sentence_ends, count(*) FILTER (regexp_matches(text, '{_CLAUSE}')) AS clause_ends FROM tok GROUP BY doc_id",
    "timestamp_render": f"SELECT event_id, {_time('(event_id * 7.1234e0 - 5)', ',')} AS srt_time, {_time('(event_id * 7.1234e0 - 5)', '.')} AS vtt_time FROM events",
    "wrap_balanced": f"""WITH {_TOK}, l AS (SELECT doc_id, pos // 9 AS line, string_agg(text, ' ' ORDER BY pos) AS text, list(text ORDER BY pos) AS t FROM tok GROUP BY 1, 2),
        s AS (SELECT *, list_min(list_filter(list_transform(range(1, len(t)), lambda i: struct_pack(
            score := greatest(length(array_to_string(t[:i], ' ')), length(array_to_string(t[i + 1:], ' '))) + abs(length(array_to_string(t[:i], ' ')) - length(array_to_string(t[i + 1:], ' '))) * 0.2e0,
            a := array_to_string(t[:i], ' '), b := array_to_string(t[i + 1:], ' '))), lambda x: length(x.a) <= 42 AND length(x.b) <= 42)) AS best FROM l)
        SELECT doc_id, line, CASE WHEN length(text) <= 42 OR best IS NULL THEN text ELSE best.a || chr(10) || best.b END AS wrapped, length(text) <= 42 OR best IS NOT NULL AS fits FROM s""",
    "chunk_manifest": f"""WITH {_CHUNKS} SELECT book_id, printf('c%02d_p%02d', chapter_id, part) AS id, chapter_id, chapter_title, part, start_frame, end_frame,
        round(start_frame / 16000, 3) AS "start", round(end_frame / 16000, 3) AS "end", round((end_frame - start_frame) / 16000, 3) AS duration FROM chunk""",
    "chunk_summary": f"WITH {_CHUNKS} SELECT count(*) AS chunks, min(round((end_frame - start_frame) / 16000, 3)) AS shortest, max(round((end_frame - start_frame) / 16000, 3)) AS longest FROM chunk",
    "config_defaults_and_violations": r"""WITH j AS (SELECT CASE WHEN s_suppkey % 11 = 0 THEN 'Job 1' WHEN s_suppkey % 13 = 0 THEN 'twin' ELSE 'job-' || s_suppkey END AS id,
            trim(CASE WHEN s_suppkey % 17 = 0 THEN ' ' WHEN s_suppkey % 2 = 0 THEN '/media/' || s_suppkey ELSE 'in/' || s_suppkey END) AS src,
            CASE WHEN s_suppkey % 3 = 0 THEN '/scratch/w' END AS wd, CASE WHEN s_suppkey % 7 = 0 THEN '../up' WHEN s_suppkey % 5 = 0 THEN 'book.v1' END AS ob,
            CASE WHEN s_suppkey % 4 = 0 THEN '/srv/project/terms.txt' END AS glossary FROM supplier)
        SELECT id, CASE WHEN src LIKE '/%' THEN src ELSE '/srv/project/' || src END AS source, coalesce(wd, '/srv/project/work/' || id) AS work_dir,
            '/srv/project/output/' || id AS output_dir, coalesce(ob, id) AS basename, glossary,
            CASE WHEN NOT regexp_full_match(id, '[A-Za-z0-9][A-Za-z0-9._-]*') THEN 'id has unsafe characters' WHEN count(*) OVER (PARTITION BY id) > 1 THEN 'duplicate job id'
                WHEN src = '' THEN 'source must be a non-empty string' WHEN NOT regexp_full_match(coalesce(ob, id), '[A-Za-z0-9][A-Za-z0-9._-]*') THEN 'output_basename has unsafe characters' END AS violation FROM j""",
    "pending_chunks": "SELECT doc_id, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "missing_chunks": "SELECT source, count(*) AS missing, min(doc_id) AS first_missing FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY source",
    "completeness": """SELECT source, count(*) AS chunks, count(n) AS recorded, coalesce(sum(n), 0)::BIGINT AS lines, count(*) = count(n) AS complete
        FROM documents LEFT JOIN (SELECT doc_id, count(*) AS n FROM labels GROUP BY 1) USING (doc_id) GROUP BY source""",
    "job_status": "SELECT c_custkey AS id, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    "last_wins_dedupe": "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value, min(event_id) AS first_pos FROM events GROUP BY user_id",
    "duplicate_job_ids": "SELECT user_id AS id, count(*) AS times FROM events GROUP BY 1 HAVING count(*) > 1",
    "candidate_pairs": f"""WITH {_PAIRS} SELECT book_id || '/' || printf('c%02d_p%02d', chapter_id, part) AS id, len({_LEX.format("a_text")})::BIGINT AS a_count, len({_LEX.format("b_text")})::BIGINT AS b_count,
        {_LEX.format("a_text")} = {_LEX.format("b_text")} AS identical FROM pair""",
    "prompt_assembly": f"""WITH {_PAIRS} SELECT book_id, chunk_pos, 'Section: ' || chapter_title || ', part ' || part || chr(10) || CASE WHEN conv_id % 2 = 0 THEN 'Reference spellings and domain terms:' || chr(10) || 'Ada, Bly' || chr(10) || chr(10) ELSE '' END
        || 'CANDIDATE A:' || chr(10) || a_text || chr(10) || chr(10) || 'CANDIDATE B:' || chr(10) || b_text || chr(10) || chr(10) || 'Return only the faithful consensus transcript.' AS prompt FROM pair""",
    "count_bounds_validation": f"""WITH {_PAIRS}, c AS (SELECT *, CASE WHEN chunk_pos % 5 = 0 THEN a_text || ' ```' ELSE a_text END AS cand FROM pair),
        n AS (SELECT *, len({_LEX.format("cand")}) AS k, len({_LEX.format("a_text")}) AS a, len({_LEX.format("b_text")}) AS b FROM c)
        SELECT book_id, chunk_pos, cand <> '' AND NOT contains(cand, '```') AND k >= 0.9e0 * greatest(least(a, b), CASE WHEN least(a, b) = 0 THEN 1 ELSE 0 END) AND k <= 1.05e0 * greatest(a, b, 1) AS within FROM n""",
    "retry_purge": """SELECT event_id, method FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'remote-mechanical-FALLBACK' WHEN 1 THEN 'remote-error-fallback' WHEN 2 THEN 'identical' WHEN 3 THEN 'remote:m' END AS method FROM events)
        WHERE NOT contains(coalesce(lower(method), ''), 'fallback')""",
    "null_timestamp_repair": f"""WITH {_TIMED} SELECT doc_id, pos, round(0.5e0 + "start", 3) AS "start", round(0.5e0 + CASE WHEN pos % 7 <> 0 THEN "end" ELSE 9999e0 END, 3) AS "end" FROM timed WHERE pos % 13 <> 0""",
    "words_sorted": f"""WITH {_TIMED}, w AS (SELECT doc_id, text, (start_ms - CASE WHEN (pos // 8) % 2 = 1 THEN 300 ELSE 0 END) / 1000e0 AS "start", (end_ms - CASE WHEN (pos // 8) % 2 = 1 THEN 300 ELSE 0 END) / 1000e0 AS "end", pos // 8 AS chunk_pos, pos % 8 AS word_pos FROM timed)
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY "start", "end", chunk_pos, word_pos) - 1 AS pos FROM w""",
    "gap_islands": f"""WITH {_ISLANDS} SELECT doc_id, island, count(*) AS words, min("start") AS "start", max("end") AS "end" FROM isl GROUP BY 1, 2""",
    "event_islands": """WITH m AS (SELECT event_id, user_id, epoch_us(ts) / 60000000e0 AS t FROM events),
        o AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) < 480e0 THEN 0 ELSE 1 END AS opens FROM m),
        i AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY t, event_id)::BIGINT AS island FROM o)
        SELECT user_id, island, count(*) AS events, min(event_id) AS least_event, max(event_id) AS last_event FROM i GROUP BY 1, 2""",
    "anchor_consistency": f"WITH {_ANCHORS} SELECT doc_id, pos, delta, median, accepted FROM acc",
    "fused_words": f"WITH {_FUSED} SELECT doc_id, pos, coalesce(accepted, false) AS accepted, new_start, new_end FROM fused",
    "fusion_counts": f"WITH {_FUSED} SELECT doc_id, count(*) AS words, count(*) FILTER (accepted) AS fused, count(*) FILTER (NOT accepted) AS rejected_matches FROM fused GROUP BY doc_id",
    "cue_segments": f"{_CUES} SELECT * FROM cues",
    "cue_timing": f"""{_TIMED_CUES} SELECT doc_id, cue, round("start", 3) AS "start", round("end", 3) AS "end" FROM tc""",
    "cue_repair": f"""{_REPAIRED} SELECT doc_id, cue, round("start", 3) AS "start", round("end", 3) AS "end" FROM final""",
    "srt_lines": f"""{_REPAIRED} SELECT doc_id, cue, cue || chr(10) || {_time('"start"', ",")} || ' --> ' || {_time('"end"', ",")} || chr(10) || text || chr(10) || chr(10) AS block FROM final""",
    "vtt_lines": f"""{_REPAIRED} SELECT doc_id, cue, {_time('"start"', ".")} || ' --> ' || {_time('"end"', ".")} || chr(10) || text || chr(10) || chr(10) AS block FROM final""",
    "qc_report": f"""{_REPAIRED},
        c AS (SELECT *, lead("start") OVER (PARTITION BY doc_id ORDER BY cue) AS nx, length(replace(text, chr(10), '')) / greatest("end" - "start", 0.001e0) AS cps FROM final),
        q AS (SELECT doc_id, count(*) AS cues, round(arg_min("start", cue), 3) AS first_cue_start, round(arg_max("end", cue), 3) AS last_cue_end,
            max(list_max(list_transform(string_split(text, chr(10)), lambda x: length(x)))) AS max_line_length, round(max("end" - "start"), 3) AS max_cue_duration,
            count(*) FILTER ("end" >= nx) AS overlap_count, count(*) FILTER (cps > 25) AS cues_over_25_cps, round(max(cps), 3) AS max_cps, count(*) FILTER ("end" < "start") AS inverted_cues FROM c GROUP BY doc_id),
        by_word AS (SELECT doc_id, count(*) AS words, count(*) FILTER ("start" = "end") AS z, count(*) FILTER ("end" < "start") AS neg FROM timed GROUP BY doc_id)
        SELECT doc_id, 1::BIGINT AS chunks, CASE WHEN doc_id % 3 = 0 THEN 'd' || doc_id ELSE '' END AS surface_restore_failures, coalesce(words, 0) AS words, coalesce(z, 0) AS zero_duration_words_from_aligner_quantization,
            coalesce(neg, 0) AS negative_word_timings, coalesce(cues, 0) AS cues, first_cue_start, last_cue_end, coalesce(max_line_length, 0) AS max_line_length, coalesce(max_cue_duration, 0) AS max_cue_duration,
            coalesce(overlap_count, 0) AS overlap_count, coalesce(cues_over_25_cps, 0) AS cues_over_25_cps, coalesce(max_cps, 0) AS max_cps, coalesce(inverted_cues, 0) AS inverted_cues
        FROM documents LEFT JOIN by_word USING (doc_id) LEFT JOIN q USING (doc_id)""",
    "transcript_text": f"""WITH {_CHUNKS}, c AS (SELECT *, lag(chapter_id) OVER (PARTITION BY book_id ORDER BY chunk_pos) AS was FROM chunk)
        SELECT book_id, chunk_pos, CASE WHEN was IS NULL THEN chapter_title || chr(10) || chr(10) WHEN was <> chapter_id THEN chr(10) || chr(10) || chapter_title || chr(10) || chr(10) ELSE '' END || {_STRIP.format("text")} || ' ' AS part FROM c""",
    "surface_restore": f"""WITH {_TIMED}, n AS (SELECT *, regexp_replace(lower(text), '[^a-z0-9]+', '', 'g') AS norm FROM timed),
        h AS (SELECT doc_id, pos * 2 AS pos, norm[1:length(norm) // 2] AS text, "start" AS s, ("start" + "end") / 2 AS e FROM n WHERE norm <> '' AND NOT (doc_id % 4 = 0 AND pos = 0)
            UNION ALL SELECT doc_id, pos * 2 + 1, norm[length(norm) // 2 + 1:], ("start" + "end") / 2, "end" FROM n WHERE norm <> '' AND NOT (doc_id % 4 = 0 AND pos = 0)),
        i AS (SELECT *, sum(length(text)) OVER (PARTITION BY doc_id ORDER BY pos) AS hi, sum(length(text)) OVER (PARTITION BY doc_id ORDER BY pos) - length(text) AS lo FROM h WHERE text <> ''),
        f AS (SELECT doc_id, pos, text, norm, sum(length(norm)) OVER (PARTITION BY doc_id ORDER BY pos) AS hi, sum(length(norm)) OVER (PARTITION BY doc_id ORDER BY pos) - length(norm) AS lo FROM n),
        eq AS (SELECT doc_id FROM (SELECT doc_id, string_agg(norm, '' ORDER BY pos) AS x FROM f GROUP BY 1) JOIN (SELECT doc_id, string_agg(text, '' ORDER BY pos) AS y FROM i GROUP BY 1) USING (doc_id) WHERE x = y AND x <> ''),
        c AS (SELECT f.doc_id, f.pos, any_value(f.text) AS text, arg_min(i.s, i.pos) AS s, arg_max(i.e, i.pos) AS e FROM f LEFT JOIN i ON f.doc_id = i.doc_id AND i.lo < f.hi AND i.hi > f.lo GROUP BY 1, 2),
        g AS (SELECT doc_id FROM c GROUP BY 1 HAVING bool_and(s IS NOT NULL) INTERSECT SELECT doc_id FROM eq)
        SELECT doc_id, pos, text, round(s, 4) AS "start", round(e, 4) AS "end", true AS restored FROM c WHERE doc_id IN (SELECT doc_id FROM g)
        UNION ALL SELECT doc_id, pos, text, round(s, 4), round(e, 4), false FROM i WHERE doc_id NOT IN (SELECT doc_id FROM g)""",
    "rms_quiet_boundary": """WITH s AS (SELECT user_id, value, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 4 AS w FROM events),
        r AS (SELECT user_id, w, sqrt(avg(value * value) + 1e-12) AS rms FROM s GROUP BY 1, 2 HAVING count(*) = 4),
        q AS (SELECT user_id, quantile_cont(rms, 0.08) AS threshold, count(*) AS windows FROM r GROUP BY 1)
        SELECT user_id, arg_min(w, abs(w - 5) * 1000000 + w) AS "window", round(any_value(threshold), 6) AS threshold, any_value(windows) AS windows FROM r JOIN q USING (user_id) WHERE rms <= threshold GROUP BY user_id""",
    "content_hash": "SELECT n_nationkey::BIGINT AS nationkey, sha256(n_name || chr(10)) AS sha256 FROM nation",
    "verification_report": """WITH p AS (SELECT sum(l_quantity)::BIGINT AS q, count(*) AS n FROM lineitem GROUP BY l_orderkey)
        SELECT q + 0.25e0 AS source_duration, q + 0.5e0 AS output_duration, q AS output_size, 'subrip' AS codec, n AS chapter_count, count(*) AS orders FROM p GROUP BY q, n""",
    "incremental_resume": "SELECT doc_id, n_chars::BIGINT + 1 AS n_plus, CASE WHEN doc_id % 2 = 0 THEN 0 ELSE 1 END::BIGINT AS run FROM documents",
    "checkpoint_files": """WITH u AS (SELECT 'u' || user_id AS id, min(event_id) AS a, max(event_id) AS b FROM events GROUP BY 1)
        SELECT id, CASE WHEN b % 3 <> 1 THEN b ELSE a END AS event_id FROM u WHERE a % 3 <> 0 OR b % 3 <> 1""",
    "composed_map": """WITH m AS (SELECT l_orderkey AS k, l_linenumber AS i, min(l_partkey % 7) AS j FROM lineitem GROUP BY 1, 2)
        SELECT m.k, m.i::BIGINT AS a_idx, m.j::BIGINT AS q_idx, (min(n.i) * 10)::BIGINT AS w_idx FROM m JOIN m n ON m.k = n.k AND m.j = n.j GROUP BY 1, 2, 3""",
    "purged_checkpoint": "SELECT event_id, event_id % 5 NOT IN (0, 1) AS kept FROM events",
    "chunk_planner": _PLANNER,
    "manifest_files": """SELECT 'book.wav' AS book_id, row_number() OVER (ORDER BY n_nationkey) - 1 AS chunk_pos, printf('c%02d_p01', n_nationkey) AS id, n_name AS chapter_title,
        n_nationkey * 3e0 AS "start", n_nationkey * 3e0 + 2.5e0 AS "end", 2.5e0 AS duration FROM nation""",
    "chapter_probes": """SELECT n_nationkey::BIGINT AS chapter_id, CASE WHEN n_nationkey % 3 <> 0 THEN n_name ELSE 'Chapter ' || n_nationkey END AS chapter_title,
        round_even(printf('%d.%05d', n_nationkey * 60, n_nationkey * 1111)::DOUBLE * 16000, 0)::BIGINT AS start_frame, ((n_nationkey * 60 + 55) * 16000 + 8000)::BIGINT AS end_frame FROM nation""",
    "stand_in_transcripts": f"""WITH {_CHUNKS} SELECT book_id, printf('c%02d_p%02d', chapter_id, part) AS id, 'stand-in' AS model, chapter_title AS text, 2::BIGINT AS words,
        round(start_frame / 16000, 3) AS first_start, round(round(start_frame / 16000, 3) + round((end_frame - start_frame) / 16000, 3), 3) AS last_end FROM chunk""",
    "completed_jobs": "SELECT 'r' || n_regionkey AS id, n_name FROM nation WHERE n_regionkey % 2 = 1",
}
