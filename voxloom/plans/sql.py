"""SQL that the core queries are held against, written for another engine and independently of the plans.

Character classes and lists are stated here once more, so that a wrong one in the plans doesn't pass on both sides.
"""

from __future__ import annotations

# Fixed values, in the other engine's notation: Arabic vowel marks; Arabic letters and digits; letters that can end a
# word; letters of running text; bracketed remarks and marks of a new speaker; emoji; what shows nothing; errors that stay.
MARKS = r"\x{610}-\x{61A}\x{64B}-\x{65F}\x{670}\x{6D6}-\x{6ED}"
ARABIC = r"\x{621}-\x{64A}\x{660}-\x{669}\x{66E}-\x{6FF}"
ENDING = r"\x{621}-\x{64A}\x{66E}\x{66F}\x{671}-\x{6D5}\x{6EE}\x{6EF}\x{6FA}-\x{6FF}"
RUNNING = r"\x{621}-\x{64A}"
REMARK = r"(?m)[\[(][^\])]{0,40}[\])]|^>>+\s*"
EMOJI = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{FE0F}\x{20E3}]"
UNSEEN = r"[\x{640}\x{AD}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}\x{2066}-\x{2069}\x{FEFF}]"
FOREVER = "private|members.only|join this channel|removed|terminated|violat|your country|copyright|live event|premieres|extract video id|not a valid url|unsupported url"
WHITE_SPACE = "".join(map(chr, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

WS = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
CLIPS = """clips AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY audio_file ORDER BY emitted_at DESC NULLS LAST) AS rn FROM metadata WHERE audio_file IS NOT NULL) WHERE rn = 1)"""
KEY = f"nullif(lower(trim(speaker, '{WHITE_SPACE}')), '')"
MS = f"""ms AS (
  SELECT DISTINCT * FROM (SELECT video_id, CAST(round(start * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e, nullif(upper(trim(speaker, '{WHITE_SPACE}')), '') AS speaker
  FROM turns WHERE isfinite(start) AND isfinite("end") AND abs(start) < 1.15e15 AND abs("end") < 1.15e15 AND video_id IS NOT NULL) WHERE e > s AND speaker IS NOT NULL)"""
SPANS = """spans AS (SELECT video_id, chunk_index, CAST(round(start * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e FROM chunks)"""
WORDS = """ws AS (
  SELECT video_id, pos, text, CAST(round(start * 1000) AS BIGINT) AS s, CAST(round(coalesce(CASE WHEN isnan("end") THEN start ELSE "end" END, start) * 1000) AS BIGINT) AS e, kind
  FROM (SELECT video_id, pos, min(text) AS text, min(start) AS start, max("end") AS "end", min(kind) AS kind FROM sub_words GROUP BY video_id, pos))"""
SECONDS = "CAST(sum(CAST(CASE WHEN isfinite(duration) AND abs(duration) < 1e14 THEN duration ELSE 0 END AS DECIMAL(20,6))) AS DOUBLE)"


def q(pattern: str) -> str:
    """A pattern as an SQL string."""
    return "'" + pattern.replace("'", "''") + "'"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def words(x: str) -> str:
    return f"list_filter(string_split({squeeze(f'coalesce({x}, {chr(39) * 2})')}, ' '), lambda w: w <> '')"


def strip_annotations(x: str) -> str:
    return squeeze(f"regexp_replace({x}, {q(REMARK)}, ' ', 'g')")


def clean(x: str) -> str:
    return squeeze(f"replace({strip_annotations(f'nfc_normalize(coalesce({x}, {chr(39) * 2}))')}, chr(1600), '')")


def letters(x: str) -> str:
    return rf"regexp_extract_all(coalesce({x}, ''), '[\p{{L}}\p{{N}}]')"


def share(x: str, inner: str) -> str:
    return f"CASE WHEN len({letters(x)}) = 0 THEN 0.0 ELSE len(list_filter({letters(x)}, lambda c: regexp_matches(c, {q(inner)}))) / len({letters(x)}) END"


def arabic(x: str) -> str:
    return share(x, f"[{ARABIC}]")


def latin(x: str) -> str:
    return share(x, "[A-Za-z0-9]")


def script(x: str, lang: str) -> str:
    return f"CASE {lang} WHEN 'ar' THEN {arabic(x)} WHEN 'en' THEN {latin(x)} ELSE greatest({arabic(x)}, {latin(x)}) END"


def cps(x: str, seconds: str) -> str:
    return f"length(replace({x}, ' ', '')) / greatest(coalesce({seconds}, 0.0), 1e-6)"


def number(c: str) -> str:
    return f"CASE WHEN NOT isnan({c}) THEN {c} END"


LANG = "coalesce(nullif(asr_language, ''), 'ar')"
BARE = f"regexp_replace(coalesce(text, ''), {q(f'[{MARKS}]')}, '', 'g')"
_LOCAL = "(video_url LIKE 'file://%' OR NOT regexp_matches(video_url, '^[A-Za-z][A-Za-z0-9+.-]*://'))"
_STEM = r"trim(regexp_replace(regexp_replace(regexp_replace(video_url, '^.*/', ''), '(.)\.[^.]*$', '\1'), '[^0-9A-Za-z_-]+', '_', 'g'), '_')"
_HOST = r"regexp_replace(regexp_replace(lower(regexp_extract(video_url, '^[A-Za-z]+://([^/:?#]+)', 1)), '^www\.', ''), '^m\.', '')"
_PATH = "regexp_extract(video_url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)"
_REMOTE = f"""CASE WHEN {_HOST} = 'v.example' THEN nullif(regexp_extract({_PATH}, '^/+([^/]+)', 1), '')
  WHEN {_HOST} = 'video.example' THEN CASE WHEN {_PATH} = '/watch' AND regexp_matches(video_url, '[?&]v=') THEN nullif(regexp_extract(video_url, '[?&]v=([^&#]*)', 1), '') ELSE nullif(regexp_extract({_PATH}, '^/(?:shorts|embed|live|v)/([^/]+)', 1), '') END END"""
_SOURCE = f"CASE WHEN {_LOCAL} THEN CASE WHEN {_STEM} = '' THEN 'local' ELSE {_STEM} END ELSE {_REMOTE} END"

_PERIODS = f"""WITH {MS},
m AS (SELECT *, max(e) OVER (PARTITION BY video_id, speaker ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ms),
i AS (SELECT *, sum(CASE WHEN reach >= s THEN 0 ELSE 1 END) OVER (PARTITION BY video_id, speaker ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m),
p AS (SELECT video_id, speaker, min(s) AS s, max(e) AS e FROM i GROUP BY video_id, speaker, island)"""
_VOTES = """counted AS (SELECT video_id, speaker, dialect, count(*) AS n, min(audio_file) AS seen FROM entries WHERE dialect <> 'unclear' GROUP BY ALL),
best AS (SELECT *, sum(n) OVER (PARTITION BY video_id, speaker) AS total, row_number() OVER (PARTITION BY video_id, speaker ORDER BY n DESC, seen, dialect) AS r FROM counted),
votes AS (SELECT video_id, speaker, dialect AS label, n AS votes, CAST(total AS BIGINT) AS total, n / total AS share FROM best WHERE r = 1)"""
_SLICED = """pieces AS (
  SELECT video_id, unnest(list_concat([s], cuts)) AS s, unnest(list_concat(cuts, [e])) AS e
  FROM (SELECT r.video_id, r.s, r.e, coalesce(list_sort(list(DISTINCT p.at) FILTER (p.at IS NOT NULL)), []) AS cuts
    FROM (SELECT DISTINCT video_id, s, e FROM spans WHERE e > s) r
    LEFT JOIN (SELECT DISTINCT video_id, unnest([s, e]) AS at FROM ms) p ON p.video_id = r.video_id AND p.at > r.s AND p.at < r.e GROUP BY r.video_id, r.s, r.e))"""


_OVERLAPPED = f"""WITH {MS}, pts AS (SELECT DISTINCT video_id, unnest([s, e]) AS a FROM ms), sl AS (SELECT *, lead(a) OVER (PARTITION BY video_id ORDER BY a) AS b FROM pts),
busy AS (SELECT sl.video_id, a, b FROM sl JOIN ms t ON t.video_id = sl.video_id AND t.s <= (a + b) / 2 AND (a + b) / 2 < t.e WHERE b IS NOT NULL GROUP BY ALL HAVING count(DISTINCT speaker) > 1),
slo AS (SELECT *, CASE WHEN a - lag(b) OVER (PARTITION BY video_id ORDER BY a) <= 1 THEN 0 ELSE 1 END AS opens FROM busy), sliced_runs AS (SELECT *, sum(opens) OVER (PARTITION BY video_id ORDER BY a ROWS UNBOUNDED PRECEDING) AS run FROM slo)"""


def _dominant(source: str) -> str:
    return f"""ranked AS (
  SELECT x.video_id, x.s, x.e, t.speaker, least(x.e, t.e) - greatest(x.s, t.s) AS o,
    row_number() OVER (PARTITION BY x.video_id, x.s, x.e ORDER BY least(x.e, t.e) - greatest(x.s, t.s) DESC, t.s, t.e, t.speaker) AS r
  FROM (SELECT DISTINCT video_id, s, e FROM {source}) x JOIN ms t ON t.video_id = x.video_id AND t.s < x.e AND t.e > x.s),
dominant AS (SELECT video_id, s AS start, e AS "end", speaker FROM ranked WHERE r = 1 AND o >= (e - s) * 0.5)"""


_RESULTS = f"""k AS (SELECT video_id, count(*) AS kept, CAST(round({SECONDS[5:-11]}, 2) AS DOUBLE) AS seconds FROM clips GROUP BY 1), by_code AS (SELECT video_id, reject_code, count(*) AS n FROM chunks WHERE reject_code IS NOT NULL GROUP BY ALL),
r AS (SELECT video_id, CAST(sum(n) AS BIGINT) AS rejected, string_agg(reject_code || '=' || n, ' ' ORDER BY reject_code) AS reasons FROM by_code GROUP BY 1),
results AS (SELECT v.video_id, video_url AS url, coalesce(kept, 0) AS kept, coalesce(rejected, 0) AS rejected, coalesce(seconds, 0) AS seconds_kept, coalesce(reasons, '') AS reasons, error FROM videos v LEFT JOIN k USING (video_id) LEFT JOIN r USING (video_id))"""
_LINKED = "linked AS (SELECT speaker, 'GLOBAL_SPEAKER_0' || substr(md5(speaker), 1, 1) AS global_speaker FROM (SELECT DISTINCT speaker FROM metadata WHERE speaker IS NOT NULL) WHERE regexp_matches(md5(speaker), '^[0-9]'))"
_PRICE = "CAST(trunc(l_extendedprice) AS BIGINT)"


def _references(source: str) -> str:
    return f"""c AS (SELECT audio_file, duration, coalesce({KEY}, video_id) AS voice, coalesce(CASE WHEN isnan(squim_mos) THEN 0 ELSE squim_mos END, 0) AS mos, coalesce(NOT isnan(duration) AND duration BETWEEN 3 AND 10, false) AS fits FROM {source}),
r AS (SELECT *, row_number() OVER (PARTITION BY voice, fits ORDER BY mos DESC, audio_file) AS k, max(fits) OVER (PARTITION BY voice) AS any_fit, row_number() OVER (PARTITION BY voice ORDER BY audio_file) - 1 AS i FROM c),
pool AS (SELECT voice, audio_file, duration, k FROM r WHERE fits = any_fit AND k <= 12),
o AS (SELECT r.audio_file, i, p.audio_file AS ref, p.duration AS rd, row_number() OVER (PARTITION BY r.audio_file ORDER BY p.k) - 1 AS j, count(*) OVER (PARTITION BY r.audio_file) AS n FROM r JOIN pool p ON p.voice = r.voice AND p.audio_file <> r.audio_file),
refs AS (SELECT r.audio_file, o.ref, o.rd FROM r LEFT JOIN o ON o.audio_file = r.audio_file AND o.j = o.i % o.n)"""


def _clean_text(x: str) -> str:
    return f"trim({squeeze(f"regexp_replace(regexp_replace(regexp_replace(nfc_normalize({x}), {q(REMARK)}, ' ', 'g'), {q(EMOJI)}, ' ', 'g'), {q(UNSEEN)}, '', 'g')")}, ' -–—،,;:')"


def _reached(table: str, key: str, order: str, value: str, target: int) -> str:
    """``sharded`` rows: each step of the recursion finds where a key's next shard begins."""
    return f"""WITH RECURSIVE x AS (SELECT {key} AS k, {value} AS v, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS r, sum({value}) OVER (PARTITION BY {key} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS upto FROM {table}),
cuts AS (SELECT DISTINCT k, CAST(0 AS BIGINT) AS shard, CAST(0 AS HUGEINT) AS base FROM x
  UNION ALL SELECT c.k, c.shard + 1, min(x.upto) FROM cuts c JOIN x ON x.k = c.k AND x.upto >= c.base + {target} AND x.upto > c.base GROUP BY c.k, c.shard),
sharded AS (SELECT x.k, x.v, c.shard FROM x ASOF JOIN cuts c ON x.k = c.k AND x.upto > c.base)"""


def _exceeding(source: str, order: str, most: int, count: int) -> str:
    """``x``, numbered rows, and ``b``, batches by their first row ``a`` and the next one's ``z``."""
    return f"""x AS MATERIALIZED (SELECT *, row_number() OVER w AS r, sum(v) OVER w - v AS ahead FROM {source} WINDOW w AS (PARTITION BY k ORDER BY {order})),
firsts AS (SELECT DISTINCT k, CAST(0 AS BIGINT) AS batch, CAST(1 AS BIGINT) AS a, CAST(0 AS HUGEINT) AS base FROM x
  UNION ALL SELECT f.k, f.batch + 1, min(x.r), min_by(x.ahead, x.r) FROM firsts f JOIN x ON x.k = f.k AND x.r > f.a AND (x.ahead + x.v - f.base > {most} OR x.r - f.a >= {count}) GROUP BY f.k, f.batch),
b AS (SELECT *, lead(a) OVER (PARTITION BY k ORDER BY batch) AS z FROM firsts)"""


def oracle_sql() -> dict[str, str]:
    """Name to SQL."""
    peak = number("peak_dbfs")
    return {
        "p1_found": f"""{_PERIODS}
SELECT video_id, speaker, 'period' AS kind, s AS start_ms, e AS end_ms FROM p
UNION ALL SELECT * FROM (SELECT video_id, speaker, 'gap' AS kind, lag(e) OVER (PARTITION BY video_id, speaker ORDER BY s) AS start_ms, s AS end_ms FROM p) WHERE start_ms IS NOT NULL""",
        "q_gate_reasons": f"""SELECT video_id, chunk_index, coalesce(reject_code, CASE WHEN coalesce(text, '') = '' THEN 'text:empty' WHEN len({words('text')}) < 2 THEN 'text:too_short' WHEN {script('text', LANG)} < 0.6 THEN 'text:script'
  WHEN text_source IN ('google', 'cohere', 'google_batch') AND {number('asr_confidence')} < CASE WHEN text_source IN ('google', 'google_batch') THEN 0.5 ELSE -1.0 END THEN 'text:asr_confidence'
  WHEN {cps('text', '("end" - start)')} < 4 THEN 'text:cps_low' WHEN {cps('text', '("end" - start)')} > 18 THEN 'text:cps_high' WHEN boundary_clipped THEN 'text:boundary_clipped'
  WHEN text_source NOT IN ('google', 'cohere', 'google_batch') AND {number('align_score')} < -5.5 THEN 'align:score' END) AS reject_code FROM chunks""",
        "q_row_gates": f"""WITH {CLIPS}, cleaned AS (SELECT *, {clean('text_cohere')} AS c FROM clips)
SELECT audio_file, CASE WHEN text_source = 'pending' THEN NULL WHEN c = '' THEN 'text:empty' WHEN len({words('c')}) < 2 THEN 'text:too_short' WHEN {script('c', LANG)} < 0.6 THEN 'text:script'
  WHEN {number('asr_confidence')} < 0.5 THEN 'text:asr_confidence' WHEN {cps(f"regexp_replace(c, {q(f'[{MARKS}]')}, '', 'g')", 'duration')} < 4 THEN 'text:cps_low'
  WHEN {cps(f"regexp_replace(c, {q(f'[{MARKS}]')}, '', 'g')", 'duration')} > 18 THEN 'text:cps_high' END AS reject_code FROM cleaned""",
        "q_quality_gates": f"""WITH {CLIPS}, judged AS (SELECT audio_file, CASE
  WHEN {number('clipping_ratio')} > 0.001 THEN {{'c': 'quality:clipping', 'v': clipping_ratio}} WHEN {peak} < -35 THEN {{'c': 'quality:too_quiet', 'v': peak_dbfs}}
  WHEN {peak} > -0.5 THEN {{'c': 'quality:too_hot', 'v': peak_dbfs}} WHEN {number('snr_db')} < 12 THEN {{'c': 'quality:snr', 'v': snr_db}}
  WHEN {number('squim_stoi')} < 0.75 THEN {{'c': 'quality:stoi', 'v': squim_stoi}} WHEN {number('squim_pesq')} < 1.8 THEN {{'c': 'quality:pesq', 'v': squim_pesq}}
  WHEN {number('squim_mos')} < 3.0 THEN {{'c': 'quality:mos', 'v': squim_mos}} END AS j FROM clips)
SELECT audio_file, j.c AS reject_code, j.v AS reject_value FROM judged""",
        "q_music_gates": f"""WITH {CLIPS} SELECT audio_file, CASE WHEN {number('accompaniment_ratio')} > 0.1 THEN 'music:accompaniment' WHEN {number('music_score')} > 0.2 THEN 'music:score' END AS reject_code FROM clips""",
        "q_export_rows": f"""WITH {CLIPS}, t AS (SELECT {squeeze("coalesce(text, '')")} AS x, coalesce({number('duration')}, 0) AS d FROM clips)
SELECT CASE WHEN len({words('x')}) < 2 THEN 'text_too_short' WHEN NOT regexp_matches(x, {q(f'[{RUNNING}]')}) THEN 'no_arabic_script' WHEN d < 1 THEN 'too_short' WHEN d > 30 THEN 'too_long'
  WHEN regexp_matches(x, '[0-9٠-٩۰-۹]') THEN 'has_digits' ELSE 'kept' END AS category, count(*) AS rows FROM t GROUP BY 1""",
        "q_rejection_summary": "SELECT category, rows, rows / greatest(sum(rows) OVER (), 1) AS share FROM (SELECT coalesce(split_part(reject_code, ':', 1), 'kept') AS category, count(*) AS rows FROM chunks GROUP BY 1)",
        "q_script_ratios": f"SELECT video_id, chunk_index, {arabic('text')} AS arabic, {latin('text')} AS latin, {script('text', chr(99) + 'oalesce(asr_language, ' + chr(39) + 'ar' + chr(39) + ')')} AS script FROM chunks",
        "q_clean_output": f"SELECT video_id, chunk_index, {clean('text_yt')} AS clean FROM chunks",
        "q_clean_text": f"""SELECT doc_id, trim({squeeze(f"regexp_replace(regexp_replace(regexp_replace(nfc_normalize(coalesce(text, '')), {q(REMARK)}, ' ', 'g'), {q(EMOJI)}, ' ', 'g'), {q(UNSEEN)}, '', 'g')")}, ' -–—،,;:') AS clean FROM documents""",
        "q_vowel_marks": f"""SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), {q(f'[{MARKS}]')})) > 0 AS has,
  CASE WHEN len(regexp_extract_all({BARE}, {q(f'[{ARABIC}]')})) = 0 THEN 0.0 ELSE len(regexp_extract_all(coalesce(text, ''), {q(f'[{MARKS}]')})) / len(regexp_extract_all({BARE}, {q(f'[{ARABIC}]')})) END AS ratio,
  {BARE} AS bare, length(list_aggregate(list_transform(regexp_extract_all(coalesce(text, ''), {q(f'(?s)[{ENDING}][{ENDING}{MARKS}]*|.')}), lambda w:
    CASE WHEN regexp_matches(w, {q(f'^[{ENDING}]')}) THEN regexp_replace(regexp_replace(w, {q(f'[{MARKS}]+$')}, ''), {q('(.)' + chr(0x64B) + '([' + chr(0x627) + chr(0x649) + '])$')}, '\\1\\2') ELSE w END), 'string_agg', '')) AS without_final FROM documents""".replace("length(list_aggregate", "coalesce(list_aggregate").replace("'string_agg', ''))", "'string_agg', ''), '')"),
        "q_alignment_words": f"SELECT video_id, chunk_index, {words(strip_annotations(chr(110) + 'fc_normalize(coalesce(text_yt, ' + chr(39) * 2 + '))'))} AS words FROM chunks",
        "q_markers": "SELECT video_id, chunk_index, array_to_string(list_sort(list_intersect(list_distinct(string_split(lower(text), ' ')), ['studio', 'signal', 'archive', 'clip', 'guest'])), ' ') AS markers FROM chunks",
        "q_markup": "SELECT doc_id, regexp_replace(coalesce(text, ''), '</?[a-zA-Z][^>]*>', '', 'g') AS bare FROM documents",
        "q_prompts": "SELECT video_id, 'Transcribe ' || coalesce(title, '?') || ' (' || coalesce(language, 'ar') || ').' AS prompt FROM videos",
        "q_url_ids": f"SELECT video_id, {_SOURCE} AS source_id, {_LOCAL} AS is_local FROM videos",
        "q_source_table": f"""WITH first AS (SELECT {squeeze('video_url')} AS video_url, min(video_id) AS o FROM videos WHERE video_url IS NOT NULL GROUP BY 1)
SELECT video_url AS spec, {_SOURCE} AS source_id, {_LOCAL} AS is_local, row_number() OVER (ORDER BY NOT {_LOCAL}, o) - 1 AS ordinal FROM first WHERE video_url <> '' AND video_url NOT LIKE '#%'""",
        "q_natural_order": r"""SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(lower(p_name), '\d+|\D+'), lambda p: CASE WHEN regexp_matches(p, '^\d')
  THEN lpad(CAST(length(regexp_replace(p, '^0+(\d)', '\1')) AS VARCHAR), 6, '0') || regexp_replace(p, '^0+(\d)', '\1') ELSE p END), chr(1)) AS key FROM part""",
        "q_path_codes": "SELECT audio_file, 'batch/clips/' || regexp_replace(audio_file, '\\.[^.]*$', '') || '.flac' AS code, regexp_replace(audio_file, '\\.[^.]*$', '') || '.wav' AS back FROM metadata",
        "q_permanent_errors": f"SELECT coalesce(regexp_matches(lower(error), '{FOREVER}'), false) AS permanent, error IS NULL AS fine, count(*) AS videos FROM videos GROUP BY ALL",
        "q_locales": "SELECT lower(split_part(replace(coalesce(lang, 'und'), '_', '-'), '-', 1)) AS language, count(*) AS documents FROM documents GROUP BY 1",
        "q_caption_cues": f"""SELECT video_id || '#' || chunk_index AS video_id, len(w) AS words, CAST(len(w) - 1 AS INTEGER) AS last_pos, CAST(round(start * 1000) AS BIGINT) AS start_ms, list_max(w) AS last_text
FROM (SELECT *, {words('text')} AS w FROM chunks) WHERE len(w) > 0 AND start IS NOT NULL AND "end" IS NOT NULL""",
        "q_caption_events": f"""SELECT video_id || '#' || chunk_index AS video_id, len(w) AS words, CAST(len(w) - 1 AS INTEGER) AS last_pos, CAST(round(start * 1000) AS BIGINT) AS start_ms, greatest(CAST(round(start * 1000) AS BIGINT), CAST(round("end" * 1000) AS BIGINT)) AS end_ms
FROM (SELECT *, {words('text')} AS w FROM chunks) WHERE len(w) > 0 AND start IS NOT NULL AND "end" IS NOT NULL""",
        "q_run_state": f"""WITH {CLIPS}, st AS (SELECT video_id, count(*) AS kept, CAST(sum(CASE WHEN isfinite(duration) THEN CAST(duration AS DECIMAL(20,6)) ELSE 0 END) AS DOUBLE) AS seconds_kept FROM clips GROUP BY 1)
SELECT v.video_id AS source_id, st.video_id IS NOT NULL AS complete, coalesce(kept, 0) AS kept, CAST(0 AS BIGINT) AS rejected, coalesce(seconds_kept, 0) AS seconds_kept FROM videos v LEFT JOIN st USING (video_id)""",
        "q_pending_sources": "SELECT video_id AS source_id FROM videos WHERE video_id NOT IN (SELECT video_id FROM chunks WHERE video_id IS NOT NULL GROUP BY video_id HAVING count(*) FILTER (boundary_clipped) = 0)",
        "q_merge_gap": f"""{_PERIODS}, o AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER w AND s - lag(e) OVER w <= 300 THEN 0 ELSE 1 END AS opens FROM p WINDOW w AS (PARTITION BY video_id ORDER BY s, e, speaker)),
r AS (SELECT *, sum(opens) OVER (PARTITION BY video_id ORDER BY s, e, speaker ROWS UNBOUNDED PRECEDING) AS run FROM o)
SELECT video_id, min(s) AS start, max(e) AS "end", speaker FROM r GROUP BY video_id, run, speaker""",
        "q_overlap_sweep": f"""{_OVERLAPPED} SELECT video_id, min(a) AS start, max(b) AS "end" FROM sliced_runs GROUP BY video_id, run""",
        "q_subtract": f"""{_OVERLAPPED}, {SPANS}, holes AS (SELECT video_id, min(a) AS s, max(b) AS e FROM sliced_runs GROUP BY video_id, run),
c AS (SELECT r.id, r.video_id, r.s, r.e, coalesce(list({{'s': greatest(r.s, h.s), 'e': least(r.e, h.e)}} ORDER BY h.s) FILTER (h.s IS NOT NULL), []) AS cuts
  FROM (SELECT *, row_number() OVER () AS id FROM spans WHERE e > s) r LEFT JOIN holes h ON h.video_id = r.video_id AND h.s < r.e AND h.e > r.s GROUP BY ALL)
SELECT video_id, a AS start, b AS "end" FROM (SELECT video_id, unnest(list_concat([s], list_transform(cuts, lambda x: x.e))) AS a, unnest(list_concat(list_transform(cuts, lambda x: x.s), [e])) AS b FROM c) WHERE b > a""",
        "q_clip_to": f"""WITH {SPANS} SELECT video_id, chunk_index, greatest(s, 60000) AS start, least(e, 600000) AS "end" FROM spans WHERE least(e, 600000) > greatest(s, 60000)""",
        "q_cut_at_turns": f"""WITH {MS}, {SPANS}, {_SLICED} SELECT video_id, s AS start, e AS "end" FROM pieces WHERE e - s > 0.5""",
        "q_dominant_speaker": f"""WITH {MS}, {SPANS}, {_dominant('spans')} SELECT * FROM dominant""",
        "q_assign_speakers": f"""WITH {MS}, {SPANS}, {_SLICED}, {_dominant('pieces')} SELECT * FROM dominant
UNION ALL SELECT video_id, s AS start, e AS "end", 'SPEAKER_00' AS speaker FROM spans WHERE NOT EXISTS (SELECT 1 FROM ms WHERE ms.video_id = spans.video_id)""",
        "q_own_words": f"""WITH {SPANS}, {WORDS}, own AS (
  SELECT c.video_id, c.chunk_index, w.s, w.pos, w.text, w.s < c.s - 20 OR w.e > c.e + 20 AS clipped FROM spans c JOIN ws w ON w.video_id = c.video_id AND w.s < c.e AND greatest(w.e, w.s + 1e-6) > c.s
  WHERE least(c.e, greatest(w.e, w.s + 1e-6)) - greatest(c.s, w.s) >= 0.5 * greatest(greatest(w.e, w.s + 1e-6) - w.s, 1e-6) * (1 - 1e-12)),
g AS (SELECT video_id, chunk_index, string_agg(text, ' ' ORDER BY s, pos, text) AS text, count(*) AS n, bool_or(clipped) AS clipped FROM own GROUP BY ALL)
SELECT video_id, chunk_index, coalesce(text, '') AS text, coalesce(n, 0) AS aligned_words, coalesce(clipped, false) AS boundary_clipped FROM spans LEFT JOIN g USING (video_id, chunk_index)""",
        "q_plan_windows": 'SELECT video_id, CAST(floor(start / 30.0) AS BIGINT) AS "window", min(pos) AS first_pos, max(pos) + 1 AS end_pos FROM sub_words WHERE start IS NOT NULL GROUP BY 1, 2',
        "q_fill_ends": f"""WITH {WORDS} SELECT video_id, pos, text, s AS start, CASE WHEN e > s THEN e ELSE greatest(s, coalesce(lead(s) OVER (PARTITION BY video_id ORDER BY pos), s)) END AS "end", kind FROM ws""",
        "q_pad_filter": f"""WITH {SPANS}, padded AS (SELECT video_id, greatest(0.0, s - 200) AS a, e + 200 AS b FROM spans)
SELECT video_id, CAST(a AS DOUBLE) AS start, b AS "end", CAST(row_number() OVER (PARTITION BY video_id ORDER BY a, b) - 1 AS INTEGER) AS chunk_index FROM padded WHERE b - a >= 2000 AND b - a <= 12400""",
        "q_collapse_dominant": f"""WITH {MS}, per AS (SELECT video_id, speaker, sum(e - s) AS n FROM ms GROUP BY ALL), tot AS (SELECT video_id, sum(n) AS total, count(*) AS k, max({{'n': n, 'speaker': speaker}}) AS top FROM per GROUP BY 1)
SELECT ms.video_id, CASE WHEN k > 1 AND top.n / total >= 0.6 THEN top.speaker ELSE speaker END AS speaker, count(*) AS turns FROM ms JOIN tot USING (video_id) GROUP BY ALL""",
        "q_purity": """WITH d AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS k FROM embeddings),
m1 AS (SELECT label, k, avg(CAST(x AS DOUBLE)) AS x FROM d GROUP BY ALL), c1 AS (SELECT label, k, x / sqrt(sum(x * x) OVER (PARTITION BY label)) AS x FROM m1),
d1 AS (SELECT vec_id, label, 1 - sum(d.x * c1.x) AS dist FROM d JOIN c1 USING (label, k) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY dist, vec_id) AS r, count(*) OVER (PARTITION BY label) AS n FROM d1),
m2 AS (SELECT label, k, avg(CAST(x AS DOUBLE)) AS x FROM d JOIN r USING (vec_id, label) WHERE n < 4 OR r <= greatest(2, n // 2) GROUP BY ALL), c2 AS (SELECT label, k, x / sqrt(sum(x * x) OVER (PARTITION BY label)) AS x FROM m2)
SELECT vec_id, 1 - sum(d.x * c2.x) > 0.45 AS off_speaker, round(1 - sum(d.x * c2.x), 6) AS distance FROM d JOIN c2 USING (label, k) GROUP BY vec_id""",
        "q_centroids": """WITH d AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS k FROM embeddings), m AS (SELECT label, k, avg(CAST(x AS DOUBLE)) AS x FROM d GROUP BY ALL)
SELECT label, CAST(k - 1 AS INTEGER) AS dimension, round(x / sqrt(sum(x * x) OVER (PARTITION BY label)), 6) AS x FROM m""",
        "q_votes": f"WITH entries AS (SELECT *, coalesce(asr_language, 'unclear') AS dialect FROM metadata), {_VOTES} SELECT * FROM votes",
        "q_flags": f"""WITH {CLIPS}, entries AS (SELECT *, coalesce(asr_language, 'unclear') AS dialect FROM clips), {_VOTES},
j AS (SELECT audio_file, dialect, label, v.share, CASE WHEN isnan(asr_confidence) THEN 0 ELSE coalesce(asr_confidence, 0) END AS sure, coalesce(total >= 3 AND v.share >= 0.67, false) AS u FROM entries LEFT JOIN votes v ON v.video_id = entries.video_id AND v.speaker = entries.speaker)
SELECT audio_file, CASE WHEN u THEN label ELSE dialect END AS flag_label, CASE WHEN u THEN share ELSE sure END AS flag_confidence, CASE WHEN u THEN 'speaker_consensus' ELSE 'clip' END AS flag_basis FROM j
WHERE CASE WHEN u THEN label ELSE dialect END NOT IN ('ar', 'unclear') AND CASE WHEN u THEN share ELSE sure END >= 0.6""",
        "q_namespaced": f"WITH {MS} SELECT DISTINCT video_id || '_SPK' || speaker AS speaker FROM ms",
        "q_cache_last_wins": f"WITH {CLIPS} SELECT audio_file, video_id, chunk_index, text, emitted_at FROM clips",
        "q_first_seen": "SELECT speaker, min(audio_file) AS audio_file FROM metadata GROUP BY speaker",
        "q_outstanding": f"WITH {CLIPS} SELECT audio_file, video_id FROM clips WHERE audio_file NOT IN (SELECT audio_file FROM metadata WHERE squim_mos >= 3 AND audio_file IS NOT NULL)",
        "q_live": "SELECT video_id, chunk_index FROM chunks WHERE video_id IN (SELECT video_id FROM metadata WHERE video_id IS NOT NULL)",
        "q_orphans": "SELECT doc_id, video_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM videos v WHERE v.video_id = d.video_id)",
        "q_text_diffs": f"WITH {CLIPS} SELECT audio_file, text AS before, text_cohere AS after FROM clips WHERE text_cohere <> '' AND text IS NOT NULL AND {clean('text')} <> {clean('text_cohere')}",
        "q_overlay": f"""WITH {CLIPS}, c AS (SELECT *, CASE WHEN text_source <> 'google' THEN CASE WHEN text_cohere <> '' THEN 'ok' ELSE 'empty' END END AS st FROM clips)
SELECT coalesce(st, 'not_sent') AS gate_status, count(*) AS rows, count(*) FILTER (CASE WHEN st = 'ok' THEN coalesce(text_cohere, '') ELSE text END = '') AS empty FROM c GROUP BY 1""",
        "q_records": f"""SELECT c.* EXCLUDE (start, "end", text_source), round(start, 3) AS start, round("end", 3) AS "end", coalesce(text_source, 'none') AS text_source, video_url, title, channel, upload_date,
  coalesce(c.speaker, '_unassigned') || '/' || c.video_id || '_' || printf('%04d', chunk_index) || '.wav' AS audio_file, round("end" - start, 3) AS duration, CAST(NULL AS VARCHAR) AS global_speaker, 24000 AS sample_rate, {LANG} AS language FROM chunks c LEFT JOIN videos v USING (video_id)""",
        "q_merge_rejections": "SELECT video_id, chunk_index, reject_code FROM chunks WHERE reject_code IS NOT NULL AND reject_code NOT LIKE 'text:%' UNION ALL SELECT video_id, chunk_index, 'text:empty' AS reject_code FROM chunks WHERE text_yt = ''",
        "q_drop_videos": "SELECT video_id, count(*) AS chunks FROM chunks WHERE video_id NOT IN (SELECT video_id FROM videos WHERE error IS NOT NULL AND video_id IS NOT NULL) GROUP BY 1",
        "q_speaker_seconds": f"WITH {CLIPS} SELECT speaker, {SECONDS} AS seconds, count(*) AS clips FROM clips GROUP BY speaker",
        "q_source_share": f"WITH {CLIPS} SELECT text_source, clips, clips / greatest(sum(clips) OVER (), 1) AS share FROM (SELECT text_source, count(*) AS clips FROM clips GROUP BY 1)",
        "q_totals": f"WITH {CLIPS} SELECT count(DISTINCT video_id) AS videos, count(*) AS kept, (SELECT count(*) FROM chunks WHERE reject_code IS NOT NULL) AS rejected, coalesce({SECONDS}, 0) / 3600 AS hours FROM clips",
        "q_top_speakers": f"""WITH {CLIPS}, s AS (SELECT speaker, {SECONDS} AS seconds FROM clips WHERE speaker IS NOT NULL GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY seconds DESC, speaker) AS p FROM s)
SELECT CASE WHEN p <= 15 THEN speaker ELSE '(rest)' END AS speaker, CAST(least(p, 16) AS INTEGER) AS place, CAST(sum(CAST(seconds AS DECIMAL(30,6))) AS DOUBLE) AS seconds FROM r GROUP BY 1, 2""",
        "q_speaker_summary": f"""WITH {CLIPS}, c AS (SELECT *, {KEY} AS voice, CASE WHEN isfinite(squim_mos) THEN CAST(squim_mos AS DECIMAL(20,6)) END AS mos FROM clips)
SELECT voice, {SECONDS} AS seconds, count(*) AS clips, count(DISTINCT video_id) AS episodes, CAST(sum(mos) AS DOUBLE) / count(mos) AS mean_mos, list_slice(list(audio_file ORDER BY audio_file), 1, 5) AS samples, {SECONDS} / 3600 AS hours
FROM c WHERE voice IS NOT NULL GROUP BY voice""",
        "q_billable": f"WITH {CLIPS} SELECT CAST(sum(CAST(greatest(15, ceil(CASE WHEN isfinite(duration) THEN duration ELSE 0 END / 15) * 15) AS BIGINT)) AS BIGINT) AS billable, {SECONDS} / 60 * 0.016 AS cost, {SECONDS} * 32 / 1e6 AS million_tokens FROM clips",
        "q_references": f"WITH {CLIPS}, {_references('clips')} SELECT audio_file, ref AS ref_audio, rd AS ref_duration FROM refs",
        "q_manifest": f"""WITH {CLIPS}, kept AS (SELECT *, coalesce({KEY}, video_id) AS voice FROM clips), {_references('kept')},
short AS (SELECT k.*, o.ref, o.rd FROM kept k JOIN refs o ON o.audio_file = k.audio_file WHERE k.duration >= 1.75 OR isnan(k.duration)), there AS (SELECT audio_file FROM short)
SELECT 'audio/' || audio_file AS audio, {_clean_text("coalesce(CASE WHEN trim(text_cohere) <> '' THEN text_cohere END, text, '')")} AS text, duration, CASE WHEN ref IN (SELECT audio_file FROM there) THEN 'audio/' || ref END AS ref_audio, CASE WHEN ref IN (SELECT audio_file FROM there) THEN rd END AS ref_duration, speaker, video_id FROM short""",
        "q_train_validation": f"""WITH {CLIPS}, c AS (SELECT audio_file, coalesce({KEY}, video_id) AS voice FROM clips), r AS (SELECT audio_file, row_number() OVER (PARTITION BY voice ORDER BY md5('0' || chr(1) || audio_file), audio_file) AS k, count(*) OVER (PARTITION BY voice) AS n FROM c)
SELECT audio_file, CASE WHEN k <= least(round_even(n * CAST(0.1 AS DOUBLE), 0), n - 1) THEN 'validation' ELSE 'train' END AS split FROM r""",
        "q_export_stats": f"""WITH {CLIPS}, c AS (SELECT *, CASE WHEN isfinite(duration) AND duration > 0 THEN duration END AS d FROM clips)
SELECT count(*) AS clips, CAST(sum(CAST(d AS DECIMAL(20,6))) AS DOUBLE) AS seconds, min(d) AS shortest, max(d) AS longest, CAST(sum(CAST(d AS DECIMAL(20,6))) AS DOUBLE) / count(d) AS mean, count(DISTINCT speaker) AS voices, count(DISTINCT video_id) AS recordings FROM c""",
        "q_reference_clips": f"""WITH {CLIPS}, r AS (SELECT video_id, audio_file, row_number() OVER (PARTITION BY video_id ORDER BY squim_stoi DESC, audio_file DESC) AS k FROM clips WHERE squim_stoi IS NOT NULL AND NOT isnan(squim_stoi))
SELECT video_id, audio_file AS reference FROM r WHERE k = 1""",
        "q_single_speaker": f"WITH {MS}, x AS (SELECT video_id, speaker FROM ms UNION ALL SELECT video_id, 'SPEAKER_00' FROM videos v WHERE NOT EXISTS (SELECT 1 FROM ms WHERE ms.video_id = v.video_id)) SELECT video_id, count(*) AS turns, count(*) FILTER (speaker = 'SPEAKER_00') AS given FROM x GROUP BY 1",
        "q_best_label": f"""WITH {CLIPS}, x AS (SELECT audio_file, coalesce(CASE WHEN isnan(music_score) THEN -1 ELSE music_score END, -1) AS m, coalesce(CASE WHEN isnan(speech_score) THEN -1 ELSE speech_score END, -1) AS s FROM clips)
SELECT audio_file, CASE WHEN s > m THEN 'speech' ELSE 'music' END AS label FROM x""",
        "q_regrouped_paths": "SELECT DISTINCT audio_file, coalesce(speaker, '_unassigned') || '/' || string_split(audio_file, '/')[-1] AS path FROM metadata",
        "q_fixed_batches": "SELECT video_id, chunk_index, CAST((row_number() OVER (PARTITION BY video_id ORDER BY chunk_index) - 1) // 8 AS BIGINT) AS batch FROM chunks",
        "q_slice_rows": "SELECT doc_id FROM documents WHERE doc_id >= 100 AND doc_id < 5000",
        "q_stream_sessions": """WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM events),
r AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM o)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS events FROM r GROUP BY user_id, run""",
        "q_stream_windows": "SELECT event_type, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, count(*) AS events FROM events GROUP BY ALL",
        "q_late_transcripts": f"""WITH {CLIPS}, {WORDS}, c AS (SELECT *, CAST(round(start * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e FROM clips),
w AS (SELECT video_id, pos, text, s, greatest(e, s + 1e-6) AS e, (pos % 8) / 8.0 AS score FROM ws WHERE text IS NOT NULL),
own AS (SELECT c.audio_file, string_agg(w.text, ' ' ORDER BY w.pos, w.text) AS said, round(avg(w.score), 5) AS mean, count(*) AS n FROM c JOIN w ON w.video_id = c.video_id AND w.s < c.e AND w.e > c.s
  WHERE least(c.e, w.e) - greatest(c.s, w.s) >= 0.5 * (w.e - w.s) * (1 - 1e-12) GROUP BY 1),
x AS (SELECT c.*, own.said, own.mean, own.n, c.video_id IN (SELECT video_id FROM w WHERE video_id IS NOT NULL) AS heard FROM c LEFT JOIN own USING (audio_file))
SELECT audio_file, CASE WHEN heard THEN coalesce(said, '') ELSE text_cohere END AS text_cohere, CASE WHEN heard THEN 'google_batch' ELSE text_source END AS text_source,
  CASE WHEN heard THEN mean ELSE asr_confidence END AS asr_confidence, CAST(CASE WHEN heard THEN coalesce(n, 0) ELSE aligned_words END AS INTEGER) AS aligned_words FROM x""",
        "q_two_stage_scores": f"""WITH {CLIPS}, b AS (SELECT *, CAST((row_number() OVER (PARTITION BY video_id ORDER BY chunk_index, audio_file) - 1) // 8 AS INTEGER) AS batch FROM clips),
u AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY batch, squim_stoi DESC, audio_file DESC) AS r FROM b WHERE squim_stoi IS NOT NULL AND NOT isnan(squim_stoi))
SELECT b.audio_file, b.batch, u.audio_file AS reference, coalesce(b.batch <= u.batch, false) AS late FROM b LEFT JOIN u ON u.video_id = b.video_id AND u.r = 1""",
        "q_cut_audio": """WITH v AS (SELECT vec_id, embedding AS x, CAST(round_even(vec_id % 7 / 8.0 * 64, 0) AS INTEGER) AS a, CAST(round_even(vec_id % 11 / 8.0 * 64, 0) AS INTEGER) AS b, vec_id % 10 = 0 AS bad FROM embeddings),
c AS (SELECT *, list_transform(list_slice(x, least(a, len(x)) + 1, least(greatest(a, b), len(x))), lambda y: CAST(y AS DOUBLE)) AS part FROM v),
g AS (SELECT *, list_max(list_transform(part, lambda y: abs(y))) AS peak FROM c)
SELECT vec_id, CASE WHEN bad THEN 'quality:snr' WHEN len(part) = 0 THEN 'audio:empty' END AS reject_code, CASE WHEN NOT bad AND len(part) > 0 THEN CAST(round_even(len(part) * 48 / 64, 0) AS INTEGER) END AS samples,
  CASE WHEN NOT bad AND len(part) > 0 THEN round(part[1] * CASE WHEN peak > 0 THEN least(power(10, 6 / 20.0), power(10, -1 / 20.0) / peak) ELSE 1 END, 6) END AS first FROM g""",
        "q_best_language": f"""WITH c AS (SELECT video_id, chunk_index, unnest([{{'language': 'ar', 'p': 0, 't': text_yt, 'k': {number('align_score')}}}, {{'language': 'en', 'p': 1, 't': text, 'k': {number('asr_confidence')}}}, {{'language': 'fr', 'p': 2, 't': text_cohere, 'k': {number('asr_confidence')}}}]) AS o FROM chunks),
r AS (SELECT *, row_number() OVER (PARTITION BY video_id, chunk_index ORDER BY coalesce(o.t, '') <> '' DESC, CASE WHEN coalesce(o.t, '') <> '' THEN o.k END DESC NULLS LAST, o.p) AS r FROM c)
SELECT video_id, chunk_index, o.language AS language, coalesce(o.t, '') AS text, o.k AS confidence FROM r WHERE r = 1""",
        "q_flag_report": f"""WITH {CLIPS}, entries AS (SELECT *, coalesce(asr_language, 'unclear') AS dialect, CASE WHEN isnan(asr_confidence) THEN 0 ELSE coalesce(asr_confidence, 0) END AS sure FROM clips), {_VOTES},
tally AS (SELECT video_id, speaker, string_agg(dialect || '=' || n, ' ' ORDER BY dialect) AS tally FROM counted GROUP BY ALL),
j AS (SELECT e.audio_file, dialect, sure, text, label, tally, v.share, coalesce(total >= 3 AND v.share >= 0.67, false) AS u FROM entries e LEFT JOIN votes v ON v.video_id = e.video_id AND v.speaker = e.speaker LEFT JOIN tally t ON t.video_id = e.video_id AND t.speaker = e.speaker),
f AS (SELECT audio_file, CASE WHEN u THEN label ELSE dialect END AS flag_dialect, CASE WHEN u THEN share ELSE sure END AS c, CASE WHEN u THEN 'speaker_consensus' ELSE 'clip' END AS flag_basis, dialect AS flag_clip_dialect, round(sure, 3) AS flag_clip_confidence,
  label AS flag_speaker_dialect, tally AS flag_speaker_votes, array_to_string(list_sort(list_intersect(list_distinct(string_split(lower(coalesce(text, '')), ' ')), ['studio', 'signal', 'archive', 'clip', 'guest'])), ' ') AS flag_lexical_markers FROM j)
SELECT * EXCLUDE (c), round(c, 3) AS flag_confidence, row_number() OVER (ORDER BY round(c, 3) DESC, flag_dialect, audio_file) AS place FROM f WHERE flag_dialect NOT IN ('ar', 'unclear') AND c >= 0.6""",
        "q_marks_report": f"""WITH r AS (SELECT CASE WHEN len(regexp_extract_all({BARE}, {q(f'[{ARABIC}]')})) = 0 THEN 0.0 ELSE len(regexp_extract_all(coalesce(text, ''), {q(f'[{MARKS}]')})) / len(regexp_extract_all({BARE}, {q(f'[{ARABIC}]')})) END AS ratio FROM documents)
SELECT count(*) AS rows, count(*) FILTER (ratio > 0) AS marked, round(coalesce(sum(ratio) FILTER (ratio > 0), 0) / greatest(count(*) FILTER (ratio > 0), 1), 4) AS mean_ratio FROM r""",
        "q_run_summary": f"""WITH {CLIPS}, {_RESULTS}
SELECT count(*) AS videos, CAST(sum(kept) AS BIGINT) AS kept, CAST(sum(rejected) AS BIGINT) AS rejected, sum(seconds_kept) / 3600 AS hours, count(error) AS failed, CAST(CASE WHEN count(error) > 0 AND sum(kept) = 0 THEN 1 ELSE 0 END AS INTEGER) AS exit_code FROM results""",
        "q_video_results": f"WITH {CLIPS}, {_RESULTS} SELECT * FROM results",
        "q_speaker_document": f"""WITH {CLIPS}, {_LINKED} SELECT 'per_speaker_seconds' AS part, speaker AS key, {SECONDS} AS seconds, NULL AS value FROM clips WHERE speaker IS NOT NULL GROUP BY speaker
UNION ALL SELECT 'per_video_seconds', video_id, {SECONDS}, NULL FROM clips WHERE video_id IS NOT NULL GROUP BY video_id UNION ALL SELECT 'global_speakers', speaker, NULL, global_speaker FROM linked""",
        "q_global_speakers": f"""WITH {CLIPS}, {_LINKED} SELECT CASE WHEN audio_file IN (SELECT audio_file FROM metadata WHERE text <> '' AND audio_file IS NOT NULL) THEN coalesce(l.global_speaker, '_unassigned') || '/' || string_split(audio_file, '/')[-1] ELSE audio_file END AS audio_file,
  c.speaker, l.global_speaker FROM clips c LEFT JOIN linked l ON l.speaker = c.speaker""",
        "q_replaced_texts": f"""WITH {CLIPS}, l AS (SELECT *, coalesce(NOT boundary_clipped, true) AS there FROM clips), d AS (SELECT * FROM l WHERE there AND text_source <> 'google' AND text_cohere <> '' AND text IS NOT NULL AND {clean('text')} <> {clean('text_cohere')})
SELECT 'before' AS part, count(*) AS rows FROM l UNION ALL SELECT 'metadata', count(*) FROM l WHERE there UNION ALL SELECT 'orphans', count(*) FROM l WHERE NOT there UNION ALL SELECT 'diffs', count(*) FROM d
UNION ALL SELECT 'report', (SELECT count(*) FROM l WHERE there) - (SELECT count(*) FROM d)""",
        "q_centroid_union": "SELECT vec_id % 97 AS speaker, max(vec_id) AS file, arg_max(embedding[1], vec_id) AS first FROM embeddings GROUP BY 1",
        "q_written_split": "SELECT video_id, count(*) AS rows, CASE WHEN reject_code IS NULL THEN 'kept' ELSE 'rejected' END AS part FROM chunks GROUP BY ALL",
        "q_versioned": "SELECT video_id, chunk_index, text FROM chunks WHERE text <> ''",
        "q_failed_list": f"SELECT DISTINCT {squeeze('video_url')} AS spec FROM videos WHERE error IS NOT NULL AND {squeeze('video_url')} <> ''",
        "q_jsonl": "SELECT video_id, chunk_index, text FROM chunks UNION ALL SELECT video_id, chunk_index, text FROM chunks",
        "q_cache_lines": f"WITH {CLIPS} SELECT audio_file, CASE WHEN text_source = 'cohere' THEN 'ok' ELSE 'error' END AS status FROM clips",
        "q_word_cache": f"""WITH {WORDS} SELECT video_id, pos, text, s AS start, e AS "end", (pos % 8) / 8.0 AS score FROM ws WHERE video_id IS NOT NULL""",
        "q_diarization": f"""WITH {MS} SELECT video_id, s AS start, e AS "end", speaker FROM ms""",
        "q_listing": "SELECT video_id AS spec, CAST(min(CASE WHEN channel IS NULL THEN 1 ELSE 2 END) AS INTEGER) AS depth FROM videos WHERE video_id IS NOT NULL GROUP BY 1",
        "q_tracks": "SELECT doc_id, CASE WHEN lang LIKE 'ar%' AND lang NOT LIKE '%-orig' OR lang = 'en' THEN lang END AS lang, CASE WHEN lang LIKE 'ar%' AND lang NOT LIKE '%-orig' OR lang = 'en' THEN CASE WHEN kind = 'caption' THEN 'yt_manual' ELSE 'yt_auto' END END AS kind FROM documents",
        "q_newest_file": """WITH f AS (SELECT video_id, doc_id || '.' || coalesce(lang, 'und') || CASE WHEN doc_id % 2 = 0 THEN '.json3' ELSE '.vtt' END AS path, crawled_at FROM documents WHERE video_id IS NOT NULL AND crawled_at IS NOT NULL)
SELECT video_id, path FROM f QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY CASE WHEN contains(path, '.ar.') THEN 0 WHEN contains(path, '.en.') THEN 1 ELSE 2 END, NOT ends_with(path, '.json3'), crawled_at DESC, path) = 1""",
        "q_stream_commits": "SELECT video_id, count(*) AS chunks FROM chunks GROUP BY 1",
        "q_first_arrivals": "SELECT DISTINCT user_id FROM events",
        "q_retry_queue": f"WITH {CLIPS} SELECT audio_file, video_id FROM clips WHERE audio_file NOT IN (SELECT audio_file FROM metadata WHERE squim_mos >= 3 AND audio_file IS NOT NULL)",
        "q_to_upload": "SELECT video_id || '/' || chunk_index AS path FROM chunks WHERE video_id || '/' || chunk_index NOT IN (SELECT video_id || '/' || chunk_index FROM metadata WHERE video_id IS NOT NULL AND chunk_index IS NOT NULL)",
        "q_shards": f"""{_reached('lineitem', 'l_returnflag', f'l_orderkey, l_linenumber, {_PRICE}', _PRICE, 5_000_000)} SELECT k AS l_returnflag, shard, CAST(sum(v) AS BIGINT) AS bytes, count(*) AS rows FROM sharded GROUP BY ALL""",
        "q_shard_names": f"""{_reached('lineitem', 'l_linestatus', f'l_orderkey, l_linenumber, {_PRICE}', _PRICE, 5_000_000)}, n AS (SELECT k, shard, count(*) AS rows FROM sharded GROUP BY ALL)
SELECT printf('data/%s/train-%05d-of-%05d.parquet', k, shard, max(shard) OVER (PARTITION BY k) + 1) AS name, rows FROM n""",
        "q_batches": f"""WITH RECURSIVE {SPANS}, {_exceeding("(SELECT video_id AS k, chunk_index, e - s AS v FROM spans)", 'chunk_index', 20_000, 4)} SELECT x.k AS video_id, x.chunk_index, x.v AS ms, b.batch FROM x JOIN b ON b.k = x.k AND x.r >= b.a AND x.r < coalesce(b.z, 1152921504606846976)""",
        "q_commit_batches": f"""WITH RECURSIVE {_exceeding("(SELECT o_orderpriority AS k, printf('%012d', o_orderkey) AS path, CAST(trunc(o_totalprice) AS BIGINT) AS v FROM orders)", 'path', 4_000_000, 40)} SELECT x.k AS folder, b.batch, count(*) AS files, CAST(sum(x.v) AS BIGINT) AS bytes FROM x JOIN b ON b.k = x.k AND x.r >= b.a AND x.r < coalesce(b.z, 1152921504606846976) GROUP BY ALL""",
        "q_stream_dedupe": """WITH RECURSIVE e AS (SELECT user_id, event_type, ts, min(event_id) AS event_id FROM events GROUP BY ALL), kept AS (SELECT user_id, event_type, min(ts) AS ts FROM e GROUP BY ALL
  UNION ALL SELECT k.user_id, k.event_type, min(e.ts) FROM kept k JOIN e ON e.user_id = k.user_id AND e.event_type = k.event_type AND e.ts > k.ts + INTERVAL 1 HOUR GROUP BY ALL)
SELECT e.event_id, e.user_id FROM kept JOIN e USING (user_id, event_type, ts)""",
        "q_prediction_entries": f"""WITH {CLIPS} SELECT regexp_replace(audio_file, '\\.[^.]*$', '') || '.wav' AS audio_file, CASE WHEN asr_language = 'fr' THEN 'batch:quota' WHEN boundary_clipped THEN 'index_mismatch' WHEN text_source = 'google' THEN 'unparseable' ELSE 'ok' END AS status FROM clips""",
        "q_recognized": """WITH x AS (SELECT text, coalesce("end" - start, 0) >= 0.1 AS sent FROM chunks) SELECT CASE WHEN sent THEN 'ok' ELSE 'not_sent' END AS status, count(*) AS rows, count(*) FILTER (sent AND text IS NOT NULL) AS same FROM x GROUP BY ALL""",
        "q_signal_stats": """WITH f AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings),
g AS (SELECT vec_id, x, list_transform(range(0, len(x) // 8), lambda i: list_avg(list_transform(list_slice(x, i * 8 + 1, i * 8 + 8), lambda y: y * y))) AS e FROM f)
SELECT vec_id, round(20 * log10(list_max(list_transform(x, lambda y: abs(y)))), 3) AS peak_dbfs, round(20 * log10(sqrt(list_avg(list_transform(x, lambda y: y * y)))), 3) AS rms_dbfs,
  round(len(list_filter(x, lambda y: abs(y) >= 0.999)) / len(x), 6) AS clipping_ratio, round(10 * log10(list_aggregate(e, 'quantile_cont', 0.9) / list_aggregate(e, 'quantile_cont', 0.1)), 3) AS snr_db FROM g""",
        "q_status_counts": f"WITH {CLIPS} SELECT CASE WHEN text_source <> 'google' THEN CASE WHEN text_cohere <> '' THEN 'ok' ELSE 'empty' END ELSE 'not_sent' END AS status, count(*) AS rows FROM clips GROUP BY 1",
        "q_overlay_marks": f"""WITH {CLIPS}, o AS (SELECT *, text_cohere IS NOT NULL AND (text_source = 'cohere' OR text_yt = text) AS ok FROM clips), n AS (SELECT audio_file, CASE WHEN coalesce(ok, false) THEN text_cohere ELSE text END AS text, coalesce(ok, false) AS ok, text_source AS ts FROM o)
SELECT audio_file, text, CASE WHEN ok AND ts NOT LIKE '%+diacritized' THEN ts || '+diacritized' ELSE ts END AS text_source, CASE WHEN ok THEN 'diacritized' END AS tashkeel_source,
  CASE WHEN len(regexp_extract_all({BARE}, {q(f'[{ARABIC}]')})) = 0 THEN 0.0 ELSE len(regexp_extract_all(coalesce(text, ''), {q(f'[{MARKS}]')})) / len(regexp_extract_all({BARE}, {q(f'[{ARABIC}]')})) END AS tashkeel_ratio FROM n""",
        "q_outstanding_first": f"WITH {CLIPS} SELECT audio_file, video_id FROM clips WHERE audio_file NOT IN (SELECT audio_file FROM metadata WHERE squim_mos >= 3 AND audio_file IS NOT NULL) ORDER BY audio_file LIMIT 25",
        "q_label_runs": """WITH e AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS k FROM embeddings), p AS (SELECT *, CASE WHEN x > 0.1 THEN 2 WHEN x > 0 THEN 1 ELSE 0 END AS label FROM e),
o AS (SELECT *, CASE WHEN label = lag(label) OVER w THEN 0 ELSE 1 END AS opens FROM p WINDOW w AS (PARTITION BY vec_id ORDER BY k)), r AS (SELECT *, sum(opens) OVER (PARTITION BY vec_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS run FROM o)
SELECT vec_id, CAST(min(k) AS INTEGER) AS first, CAST(max(k) + 1 AS INTEGER) AS until, label, round(avg(CAST(x AS DOUBLE)), 6) AS score FROM r WHERE label <> 0 GROUP BY vec_id, run, label""",
        "q_vector_means": """WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) - 1 AS k FROM embeddings)
SELECT vec_id, round(avg(x) FILTER (x > 0), 6) AS mean, round(avg(x) FILTER (k % 5 NOT IN (0, 3)), 6) AS confidence FROM e GROUP BY vec_id""",
        "q_wav": "SELECT vec_id, len(embedding) / 64.0 AS seconds, CAST(round_even(0.75 * 64, 0) - round_even(0.25 * 64, 0) AS INTEGER) AS samples, round(trunc(greatest(-1.0, least(1.0, CAST(embedding[17] AS DOUBLE) * 4)) * 32767) / 32768, 6) AS first FROM embeddings",
        "q_feed": "SELECT video_id AS guid, trim(title) AS title, video_url AS url, CAST(7 AS BIGINT) AS length FROM videos WHERE video_url IS NOT NULL",
    }
