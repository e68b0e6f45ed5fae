"""The same queries in DuckDB's SQL, written from the rules and not from the plans."""

from __future__ import annotations

from ..functions.text import PII, SPACE, pii_mark

_EXT = r"lower(regexp_extract({k}, '(?:^|/)\.*[^/.][^/]*(\.[^./]*)$', 1))"
_MODALITY = (
    "CASE WHEN {e} IN ('.txt','.md','.pdf','.docx','.html','.csv','.json') THEN 'text' "
    "WHEN {e} IN ('.jpg','.jpeg','.png','.tiff','.tif','.webp','.bmp') THEN 'image' "
    "WHEN {e} IN ('.mp3','.wav','.flac','.m4a','.aac','.ogg') THEN 'audio' "
    "WHEN {e} IN ('.mp4','.mov','.avi','.mkv','.webm') THEN 'video' END"
)


def _clean(t: str) -> str:
    return f"trim(regexp_replace({t}, '{SPACE}+', ' ', 'g'), ' ')"


def _redact(t: str) -> str:
    for label, p in PII.items():
        p = p.replace("{b}", r"\b").replace("{s}", r"\s")
        t = f"regexp_replace({t}, '{p}', '{pii_mark(label)}', 'g')"
    return t


def _spans(n: str, w: str, o: str) -> str:
    """How many windows."""
    return f"(CASE WHEN {n} <= {o} THEN 1 ELSE ceil(({n} - {o}) / ({w} - {o})::DOUBLE)::BIGINT + 1 END)"


def _start(n: str, i: str, w: str, o: str) -> str:
    return f"(CASE WHEN {n} > {o} AND {i} = {_spans(n, w, o)} - 1 THEN {n} - {o} ELSE {i} * ({w} - {o}) END)"


def _chunks(source: str, ids: str, t: str) -> str:
    """ids, ordinal and chunk of a relation source with text t."""
    n = f"length({t})"
    return f"""(SELECT {ids}, i AS ordinal, substring({t}, ({_start(n, "i", "1000", "100")} + 1)::BIGINT,
        (least({_start(n, "i", "1000", "100")} + 1000, {n}) - {_start(n, "i", "1000", "100")})::BIGINT) AS c
        FROM (SELECT *, unnest(range({_spans(n, "1000", "100")})) AS i FROM {source}))"""


_TURNS = """t AS (SELECT conv_id, turn, {text} AS text, 1000 + 40 * length(text) AS ms,
    sum(1000 + 40 * length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS e FROM conversations),
  rec AS (SELECT conv_id, max(e)::BIGINT AS n FROM t GROUP BY conv_id),
  w AS (SELECT conv_id, i AS ordinal, """ + _start("n", "i", "30000", "5000") + """ AS s, least(""" + _start("n", "i", "30000", "5000") + """ + 30000, n) AS f
        FROM (SELECT *, unnest(range(""" + _spans("n", "30000", "5000") + """)) AS i FROM rec))"""


def _audio_chunks(text: str) -> str:
    return f"""WITH {_TURNS.format(text=text)}
SELECT w.conv_id, w.ordinal::INTEGER AS ordinal, w.s::BIGINT AS start_ms, w.f::BIGINT AS end_ms,
       md5(coalesce(string_agg(t.text, ' ' ORDER BY t.turn), '')) AS text_md5
FROM w LEFT JOIN t ON t.conv_id = w.conv_id AND t.e - t.ms < w.f AND t.e > w.s GROUP BY ALL"""


_IMAGE = """img AS (SELECT p_partkey, 3 * p_size * p_size AS w, 2 * p_size * p_size AS h,
  CASE split_part(p_type, ' ', 1) WHEN 'STANDARD' THEN 'JPEG' WHEN 'PROMO' THEN 'PNG' WHEN 'ECONOMY' THEN 'WEBP' WHEN 'MEDIUM' THEN 'TIFF' WHEN 'SMALL' THEN 'GIF' WHEN 'LARGE' THEN 'BMP' ELSE '' END AS f,
  (p_partkey % 30) AS mb FROM part),
imr AS (SELECT *, CASE WHEN w < 32 OR h < 32 THEN 'Image too small: ' || w || 'x' || h
  WHEN f NOT IN ('JPEG','PNG','TIFF','WEBP','BMP') THEN 'Unsupported image format: ' || f
  WHEN mb > 25 THEN 'Image exceeds max size: ' || mb || '.0MB' END AS why FROM img)"""
_AUDIO = """aud AS (SELECT event_id, event_type, (event_id % 200) * 20 + 0.5 - 0.5 * (event_id % 2) AS d, 4000 * (1 + event_id % 5) AS r FROM events),
aur AS (SELECT *, CASE WHEN d <= 0.5 THEN 'Audio too short: ' || d::DOUBLE || 's' WHEN d > 3600 THEN 'Audio exceeds max duration: ' || d::DOUBLE || 's'
  WHEN r < 8000 THEN 'Sample rate too low: ' || r || 'Hz' END AS why FROM aud)"""
_VIDEO = """vid AS (SELECT o_orderkey, (o_orderkey % 100) * 80 - 80 AS d, CASE left(o_orderpriority, 1) WHEN '1' THEN 'h264' WHEN '2' THEN 'hevc' WHEN '3' THEN 'vp9' WHEN '4' THEN 'H264' WHEN '5' THEN 'av1' ELSE '' END AS c,
  640 + 640 * (o_orderkey % 7) AS w FROM orders),
vir AS (SELECT *, CASE WHEN d <= 0 THEN 'Zero/invalid video duration (likely corrupt container)' WHEN d > 7200 THEN 'Video exceeds max duration: ' || d::DOUBLE || 's'
  WHEN c NOT IN ('h264','hevc','vp9','vp8') THEN 'Unsupported video codec: ' || c
  WHEN w > 3840 THEN 'Video resolution exceeds max: ' || w || 'x' || (w * 9 // 16) END AS why FROM vid)"""

_SCENES = """ev AS (SELECT user_id, ts::DATE AS day, (floor(epoch(ts))::BIGINT % 86400)::DOUBLE AS cut FROM events),
bd AS (SELECT user_id, day, b, row_number() OVER w AS i, count(*) OVER (PARTITION BY user_id, day) AS n
  FROM (SELECT user_id, day, cut AS b FROM ev UNION SELECT user_id, day, 0.0 FROM ev UNION SELECT user_id, day, 86400.0 FROM ev)
  WINDOW w AS (PARTITION BY user_id, day ORDER BY b)),
fold AS (SELECT user_id, day, i, n, b AS at, NULL::DOUBLE AS s, NULL::DOUBLE AS e FROM bd WHERE i = 1
  UNION ALL SELECT f.user_id, f.day, bd.i, bd.n, CASE WHEN bd.b - f.at >= 3600 OR bd.i = bd.n THEN bd.b ELSE f.at END,
    CASE WHEN bd.b - f.at >= 3600 OR bd.i = bd.n THEN f.at END, CASE WHEN bd.b - f.at >= 3600 OR bd.i = bd.n THEN bd.b END
  FROM fold f JOIN bd ON bd.user_id = f.user_id AND bd.day = f.day AND bd.i = f.i + 1),
merged AS (SELECT user_id, day, s, e, count(*) OVER (PARTITION BY user_id, day) AS k, row_number() OVER (PARTITION BY user_id, day ORDER BY s) - 1 AS x FROM fold WHERE e IS NOT NULL),
scene AS (SELECT user_id, day, x, s, e FROM merged WHERE k >= 2
  UNION ALL SELECT user_id, day, j, j * 1800.0, (j + 1) * 1800.0 FROM (SELECT DISTINCT user_id, day FROM merged WHERE k < 2), range(48) AS r(j))"""

_MARKS = [(k, pii_mark(k)) for k in PII]


def _half(first: int) -> str:
    """32 sign bits of an embedding from that element on."""
    return f"list_sum(list_transform(range({first}, {first + 32}), lambda i: CASE WHEN embedding[i] > 0 THEN 1::BIGINT << (i - {first})::INTEGER ELSE 0 END))::BIGINT"


_NEAR = f"""bits AS MATERIALIZED (SELECT vec_id, {_half(1)} AS lo32, {_half(33)} AS hi32 FROM embeddings),
near AS MATERIALIZED (SELECT a.vec_id AS lo, b.vec_id AS hi FROM bits a JOIN bits b ON a.vec_id < b.vec_id AND bit_count(xor(a.lo32, b.lo32)) + bit_count(xor(a.hi32, b.hi32)) <= 20)"""
_V0 = "(2 * (('0x' || substr(md5({t} || ':0'), 1, 8))::BIGINT % 2001 - 1000))"


def _records(fused: bool) -> str:
    """Rows of the vector records of the embeddings' stand-in chunks."""
    base = """WITH c AS (SELECT vec_id, ['text','image','audio','video'][vec_id % 4 + 1] AS modality,
      CASE WHEN vec_id % 3 = 0 THEN '' ELSE 'said ' || vec_id END AS text,
      CASE WHEN vec_id % 2 = 1 AND vec_id % 5 <> 0 THEN 'k/' || vec_id || '.png' ELSE '' END AS path FROM embeddings),"""
    t, i = _V0.format(t="text"), _V0.format(t="path")
    key = "CASE WHEN path = '' THEN '' ELSE 'processed/' || modality || '/' || vec_id || '/chunks/c' || vec_id || '.png' END AS processed_media_key"
    if fused:
        video = f"""SELECT 'c' || vec_id, modality, NULL, false, {key}, CASE WHEN text = '' THEN {i} WHEN path = '' THEN {t} ELSE NULL END AS v0,
          CASE WHEN text <> '' AND path <> '' THEN ({t} + {i}) // 2 END AS mean FROM c WHERE modality = 'video' AND (text <> '' OR path <> '')"""
        video = f"SELECT * EXCLUDE (mean) REPLACE (coalesce(v0, mean) AS v0) FROM ({video})"
    else:
        video = f"""SELECT 'c' || vec_id, modality, NULL, path <> '', {key}, {t} FROM c WHERE modality = 'video' AND text <> ''
          UNION ALL SELECT 'c' || vec_id || '_aux', modality, 'aux_image', true, {key}, {i} FROM c WHERE modality = 'video' AND text <> '' AND path <> ''"""
    return f"""{base} r AS (
      SELECT 'c' || vec_id AS key, modality, NULL AS vector_role, false AS has_aux, {key}, {t} AS v0 FROM c WHERE modality IN ('text', 'audio') AND text <> ''
      UNION ALL SELECT 'c' || vec_id, modality, NULL, false, {key}, {i} FROM c WHERE modality = 'image' AND path <> '' UNION ALL {video})
    SELECT key, modality, vector_role, has_aux, processed_media_key, v0::BIGINT AS v0 FROM r"""


_CLEAN_TEXT, _CLEAN_HTML = _redact(_clean("text")), _redact(_clean("html"))
_N = _spans("length(x)", "1000", "100")
_ENTRIES = f"""{_IMAGE}, {_AUDIO}, {_VIDEO},
kept AS (SELECT *, row_number() OVER (PARTITION BY p_partkey % 500 ORDER BY 'raw/image/' || p_partkey || '.png') AS twin FROM imr WHERE why IS NULL),
pg AS (SELECT url, {_CLEAN_HTML} AS x, html, {_EXT.format(k="url")} AS e FROM pages),
entry AS (
  SELECT 'raw/text/' || source || '/' || doc_id || '.txt' AS s3_key, 'text' AS modality, 'success' AS status, 'ok' AS reason, {_N} AS n FROM (SELECT *, {_CLEAN_TEXT} AS x FROM documents)
  UNION ALL SELECT url, NULL, 'failed', 'Unsupported file extension ''' || e || ''' for key: ' || url, 0 FROM pg WHERE {_MODALITY.format(e="e")} IS NULL
  UNION ALL SELECT url, 'text', 'success', 'ok', {_N} FROM pg WHERE {_MODALITY.format(e="e")} = 'text'
  UNION ALL SELECT 'raw/image/' || p_partkey || '.png', 'image', 'failed', 'validation_failed: ' || why, 0 FROM imr WHERE why IS NOT NULL
  UNION ALL SELECT 'raw/image/' || p_partkey || '.png', 'image', CASE WHEN twin > 1 THEN 'skipped' ELSE 'success' END, CASE WHEN twin > 1 THEN 'duplicate_detected' ELSE 'ok' END,
    CASE WHEN twin > 1 THEN 0 WHEN greatest(w, h) <= 4096 THEN 1 ELSE ceil(w / 2048.0) * ceil(h / 2048.0) END FROM kept
  UNION ALL SELECT 'raw/audio/' || event_id || '.wav', 'audio', CASE WHEN why IS NULL AND event_id % 3 = 0 THEN 'success' ELSE 'failed' END,
    CASE WHEN why IS NOT NULL THEN 'validation_failed: ' || why WHEN event_id % 3 = 0 THEN 'ok' ELSE 'no_chunks_indexed' END,
    CASE WHEN why IS NULL AND event_id % 3 = 0 THEN {_spans("d", "30", "5")} ELSE 0 END FROM aur
  UNION ALL SELECT 'raw/video/' || o_orderkey || '.mp4', 'video', CASE WHEN why IS NULL AND o_orderkey % 3 = 0 THEN 'success' ELSE 'failed' END,
    CASE WHEN why IS NOT NULL THEN 'validation_failed: ' || why WHEN o_orderkey % 3 = 0 THEN 'ok' ELSE 'no_chunks_indexed' END,
    CASE WHEN why IS NULL AND o_orderkey % 3 = 0 THEN ceil(d / 30.0) ELSE 0 END FROM vir)"""

_DOT = "(SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)"
_SCORED = f"""v AS (SELECT vec_id AS key, ['text','image','audio','video'][label % 4 + 1] AS modality, list_inner_product(embedding::DOUBLE[], {_DOT}) AS s FROM embeddings)"""

_OBJECTS = """o AS (SELECT p_partkey AS n, p_size AS s, p_partkey % 4 AS k, ['text', 'image', 'audio', 'video'][CASE p_partkey % 4 WHEN 3 THEN 1 ELSE p_partkey % 4 + 2 END] AS modality,
    'raw/' || p_partkey || ['.jpg', '.mp3', '.mp4', '.md'][p_partkey % 4 + 1] AS source_key, ['I', 'A', 'V', 'T'][p_partkey % 4 + 1] || '|' || p_partkey || '|' || p_size AS body FROM part),
f AS (SELECT *, k IN (1, 2) AND n % 11 = 0 AS bad, n % 17 = 0 AS stuck, k = 2 AND n % 3 <> 0 AS sound FROM o),
e AS (SELECT *, CASE WHEN bad THEN 'bad file' WHEN k IN (1, 2) AND n % 7 = 0 THEN 'No ' || modality || ' stream found in ' || source_key WHEN sound AND stuck THEN 'codec failed' END AS err FROM f),
p AS (SELECT *, k IN (1, 2) AND NOT bad AND n % 7 <> 0 AS probed FROM e),
d AS (SELECT *, CASE WHEN probed AND s > 5 AND (k = 1 OR (sound AND NOT stuck)) THEN 2 ELSE 0 END AS segs, CASE WHEN k = 2 AND probed THEN CASE WHEN stuck OR s < 4 THEN greatest(ceil(s / 30.0), 0) ELSE 2 END END::INTEGER AS n_scenes FROM p),
w AS (SELECT *, CASE k WHEN 3 THEN body WHEN 0 THEN concat_ws(chr(10), CASE WHEN s % 2 = 1 THEN 'caption ' || s END, CASE WHEN n % 2 = 1 THEN 'line ' || n END)
    ELSE CASE WHEN segs = 2 THEN 'said ' || n || ' write to a' || n || '@b.org' ELSE '' END END AS said,
  CASE WHEN n_scenes > 0 THEN list_transform(range(n_scenes), lambda i: CASE WHEN stuck THEN 'none' ELSE 'F|' || n || '|' || s || '|' ||
    (CASE WHEN n_scenes = 1 THEN s / 2.0 WHEN s < 4 THEN (least(30 * i + 30, s) + 30 * i) / 2.0 ELSE (2 * i + 1) * s / 4.0 END)::DOUBLE END) END AS fr FROM d),
v AS (SELECT *, CASE WHEN err IS NOT NULL THEN 'parse_error: ' || err WHEN k = 3 THEN NULL
    WHEN k = 0 AND n % 13 = 0 THEN 'validation_failed: Image too small: 0x0' WHEN k = 0 AND (s * 20 < 32 OR s * 10 < 32) THEN 'validation_failed: Image too small: ' || s * 20 || 'x' || s * 10
    WHEN k = 1 AND s <= 0.5 THEN 'validation_failed: Audio too short: ' || s::DOUBLE || 's' WHEN k = 2 AND s <= 0 THEN 'validation_failed: Zero/invalid video duration (likely corrupt container)' END AS why FROM w),
c AS (SELECT *, why IS NULL AS ok, why IS NULL AND k IN (0, 1) AND NOT stuck AS made FROM v)"""


SQL = {
    "media_parse": f"""WITH {_OBJECTS} SELECT source_key, modality, CASE WHEN err IS NOT NULL THEN 'failed' END AS status, 'parse_error: ' || err AS reason, said AS content_text,
      CASE WHEN k = 0 THEN CASE WHEN n % 13 = 0 THEN 0 ELSE s * 20 END END::INTEGER AS width, CASE WHEN k = 0 THEN CASE WHEN n % 13 = 0 THEN 'UNKNOWN' ELSE 'PNG' END END AS format,
      CASE WHEN k = 0 AND n % 13 <> 0 THEN 'm' || s END AS make, CASE WHEN probed THEN s::DOUBLE END AS duration_sec, CASE WHEN k IN (1, 2) THEN segs END::INTEGER AS n_segments, n_scenes,
      array_to_string(fr, ';') AS frames FROM c""",
    "media_prepare": f"""WITH {_OBJECTS} SELECT source_key, CASE WHEN NOT ok THEN 'failed' END AS status, why AS reason,
      CASE WHEN said = '' THEN '' ELSE regexp_replace(said, '[a-z0-9]+@b[.]org', '[REDACTED_EMAIL]') END AS content_text,
      CASE WHEN k = 3 THEN NULL WHEN NOT made THEN source_key WHEN k = 1 THEN replace(source_key, '.mp3', '_cleaned.wav')
        ELSE replace(source_key, '.jpg', '_normalized' || CASE WHEN n % 5 = 0 THEN '_redacted' ELSE '' END || '.png') END AS media_path,
      CASE WHEN k = 3 THEN NULL ELSE body || CASE WHEN NOT made THEN '' WHEN k = 1 THEN '|audio:wav,16000,1,silence=-40dB,loudnorm' ELSE '|image:PNG' || CASE WHEN n % 5 = 0 THEN '|blur:35:0.25,0.5,0.5,0.25' ELSE '' END END END AS content,
      array_to_string(CASE WHEN ok AND n % 5 = 0 AND NOT stuck THEN list_transform(fr, lambda x: x || '|blur:35:0.25,0.5,0.5,0.25') ELSE fr END, ';') AS frames,
      CASE WHEN k = 0 THEN true END AS exif_stripped FROM c""",
    "media_manifest": f"""WITH {_OBJECTS}, m AS (SELECT *, CASE WHEN NOT ok THEN 0 WHEN k = 3 THEN 1 WHEN k = 0 THEN CASE WHEN s * 20 > 4096 THEN ceil(s * 20 / 2048.0) * ceil(s * 10 / 2048.0) ELSE 1 END
        WHEN k = 1 THEN CASE WHEN segs = 0 THEN 0 ELSE {_spans("s", "30", "5")} END ELSE CASE WHEN segs = 0 THEN 0 ELSE n_scenes END END::INTEGER AS chunks_indexed FROM c)
      SELECT source_key AS s3_key, CASE WHEN NOT ok THEN 'failed' WHEN chunks_indexed = 0 THEN 'failed' ELSE 'success' END AS status,
        CASE WHEN NOT ok THEN why WHEN chunks_indexed = 0 THEN 'no_chunks_indexed' ELSE 'ok' END AS reason, chunks_indexed FROM m""",
    "route_modality": f"""WITH k AS (SELECT url AS source_key FROM pages UNION ALL SELECT 'raw/text/' || source || '/' || doc_id || '.TXT' FROM documents
      UNION ALL SELECT 'raw/audio/' || conv_id || '.' || turn || '.wav' FROM conversations UNION ALL SELECT 'raw/video.d/' || user_id || '/.' || event_id || '.mp4' FROM events),
      x AS (SELECT source_key, {_EXT.format(k="source_key")} AS extension FROM k) SELECT *, {_MODALITY.format(e="extension")} AS modality FROM x""",
    "unsupported_extension": f"""WITH x AS (SELECT url AS source_key, {_EXT.format(k="url")} AS e FROM pages)
      SELECT source_key, 'Unsupported file extension ''' || e || ''' for key: ' || source_key AS reason FROM x WHERE {_MODALITY.format(e="e")} IS NULL""",
    "clean_text": f"SELECT doc_id, md5({_clean('text')}) AS clean_md5, length({_clean('text')}) AS n FROM documents",
    "validate_text": f"""SELECT doc_id, CASE WHEN doc_id % 7 < 3 OR regexp_replace(text, '{SPACE}+', '', 'g') = '' THEN 'Empty text content' ELSE 'ok' END AS reason FROM documents""",
    "pii_redact": f"SELECT doc_id, md5({_CLEAN_TEXT}) AS redacted_md5 FROM documents",
    "pii_counts": f"""WITH r AS (SELECT source, {_CLEAN_TEXT} AS t FROM documents)
      SELECT source, {", ".join(f"sum((length(t) - length(replace(t, '{m}', ''))) // {len(m)})::BIGINT AS {k}" for k, m in _MARKS)} FROM r GROUP BY source""",
    "chunk_text": f"SELECT doc_id, ordinal::INTEGER AS ordinal, md5(doc_id || ':' || ordinal) AS chunk_id, md5(c) AS text_md5, length(c) AS n FROM {_chunks('documents', 'doc_id', 'text')}",
    "chunk_stats": f"""SELECT source, count(*) AS chunks, sum(length(c))::BIGINT AS chars, min(length(c)) AS least, max(length(c)) AS most
      FROM {_chunks("documents", "source", "text")} GROUP BY source""",
    "text_pipeline": f"""SELECT source, count(*) AS chunks, sum(length(c))::BIGINT AS chars, count(*) AS redacted
      FROM {_chunks(f"(SELECT source, {_CLEAN_TEXT} AS x FROM documents WHERE regexp_replace(text, '{SPACE}+', '', 'g') <> '')", "source", "x")} GROUP BY source""",
    "html_pages_as_text": f"SELECT page_id, ordinal::INTEGER AS ordinal, md5(c) AS text_md5 FROM {_chunks(f'(SELECT page_id, {_clean("html")} AS x FROM pages)', 'page_id', 'x')}",
    "transcript_compose": "SELECT conv_id, md5(string_agg(text, ' ' ORDER BY turn)) AS text_md5, sum(1000 + 40 * length(text))::BIGINT AS length_ms FROM conversations GROUP BY conv_id",
    "audio_validate": f"WITH {_AUDIO} SELECT event_id, coalesce(why, 'ok') AS reason FROM aur",
    "video_validate": f"WITH {_VIDEO} SELECT o_orderkey, coalesce(why, 'ok') AS reason FROM vir",
    "image_validate": f"WITH {_IMAGE} SELECT p_partkey, coalesce(why, 'ok') AS reason FROM imr",
    "audio_windows": f"WITH {_TURNS.format(text='text')} SELECT conv_id, ordinal::INTEGER AS ordinal, s::BIGINT AS start_ms, f::BIGINT AS end_ms FROM w",
    "audio_chunks": _audio_chunks("text"),
    "audio_redact_chunks": _audio_chunks(_redact("text")),
    "scene_merge": f"WITH RECURSIVE {_SCENES} SELECT user_id, day::VARCHAR AS day, x::INTEGER AS scene_index, s AS start_sec, e AS end_sec FROM scene",
    "video_chunks": f"""WITH RECURSIVE {_SCENES}, t AS (SELECT conv_id, turn, text, (sum(1000 + 40 * length(text)) OVER (PARTITION BY conv_id ORDER BY turn)) AS f, 1000 + 40 * length(text) AS ms FROM conversations)
      SELECT user_id, day::VARCHAR AS day, x::INTEGER AS ordinal, s AS start_sec, e AS end_sec, md5(coalesce(string_agg(t.text, ' ' ORDER BY t.turn), '')) AS text_md5
      FROM scene LEFT JOIN t ON t.conv_id = user_id % 100 AND (t.f - t.ms) / 1000.0 < e AND t.f / 1000.0 > s GROUP BY ALL""",
    "keyframe_prune": """WITH RECURSIVE o AS (SELECT label, vec_id // 1000 AS part, vec_id, embedding AS v, vec_id % 17 <> 0 AS framed, row_number() OVER (PARTITION BY label, vec_id // 1000 ORDER BY vec_id) AS i FROM embeddings),
      f AS (SELECT label, part, 0::BIGINT AS i, NULL::BIGINT AS vec_id, NULL::FLOAT[] AS last, false AS kept FROM (SELECT DISTINCT label, vec_id // 1000 AS part FROM embeddings)
        UNION ALL SELECT label, part, i, vec_id, CASE WHEN framed AND NOT near THEN v ELSE last END, NOT near FROM (
          SELECT o.label, o.part, o.i, o.vec_id, o.v, o.framed, f.last,
            o.framed AND f.last IS NOT NULL AND len(list_filter(range(1, 65), lambda k: (o.v[k] > 0) <> (f.last[k] > 0))) <= 24 AS near
          FROM f JOIN o ON o.label = f.label AND o.part = f.part AND o.i = f.i + 1))
      SELECT label, vec_id::INTEGER AS vec_id FROM f WHERE kept""",
    "probe_parse": """SELECT event_id, CASE WHEN bad THEN NULL WHEN event_id % 5 = 0 THEN 7.5::DOUBLE ELSE (event_id % 1000) + 0.25::DOUBLE END AS duration_sec,
      CASE WHEN bad THEN NULL ELSE (event_id % 1000)::INTEGER END AS width, CASE WHEN bad THEN NULL ELSE round([30.0::DOUBLE, 30000::DOUBLE / 1001, 0.0, 0.0][event_id % 4 + 1], 6) END AS fps,
      CASE WHEN bad THEN NULL ELSE 'h264' END AS codec, CASE WHEN bad THEN NULL ELSE event_id % 2 = 0 END AS has_audio,
      CASE WHEN bad OR event_id % 2 = 1 THEN NULL ELSE (event_id % 7 * 8000)::INTEGER END AS sample_rate, CASE WHEN bad OR event_id % 2 = 1 THEN NULL ELSE 2 END AS channels,
      CASE WHEN bad OR event_id % 2 = 1 THEN NULL WHEN event_id % 5 = 0 THEN 0.0 ELSE (event_id % 1000) + 0.25::DOUBLE END AS audio_sec
      FROM (SELECT event_id, event_id % 11 = 0 AS bad FROM events)""",
    "image_tiles": f"""WITH {_IMAGE} SELECT p_partkey, NULL::INTEGER AS row, NULL::INTEGER AS col, NULL::INTEGER AS "left", NULL::INTEGER AS top, NULL::INTEGER AS "right", NULL::INTEGER AS bottom FROM img WHERE greatest(w, h) <= 4096
      UNION ALL SELECT p_partkey, r, c, c * 2048, r * 2048, least((c + 1) * 2048, w), least((r + 1) * 2048, h) FROM (
        SELECT *, unnest(range((w + 2047) // 2048)) AS c FROM (SELECT *, unnest(range((h + 2047) // 2048)) AS r FROM img WHERE greatest(w, h) > 4096))""",
    "phash_bits": f"""SELECT vec_id, printf('%08x%08x', {_half(33)}, {_half(1)}) AS sign_hash,
      len(list_filter(embedding::DOUBLE[], lambda x: x > list_sum(embedding::DOUBLE[]) / 64)) AS above_mean FROM embeddings""",
    "hamming_pairs": f"WITH {_NEAR} SELECT lo, hi FROM near",
    "greedy_dedup": f"""WITH RECURSIVE {_NEAR}, nbs AS (SELECT hi, list(lo) AS nb FROM near GROUP BY hi),
      o AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS i, nb FROM embeddings LEFT JOIN nbs ON hi = vec_id),
      f AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS kept UNION ALL SELECT o.i, CASE WHEN list_has_any(f.kept, coalesce(o.nb, []::BIGINT[])) THEN f.kept ELSE list_append(f.kept, o.vec_id) END FROM f JOIN o ON o.i = f.i + 1),
      k AS (SELECT unnest(kept) AS vec_id FROM (SELECT kept FROM f ORDER BY i DESC LIMIT 1))
      SELECT vec_id, vec_id NOT IN (SELECT vec_id FROM k) AS is_duplicate FROM embeddings""",
    "fuse_vectors": """WITH p AS (SELECT a.vec_id, a.embedding AS a, b.embedding AS b, b.vec_id % 5 AS m FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)
      SELECT vec_id, array_to_string(list_transform(range(1, 65), lambda i: round((CASE WHEN m < 2 THEN a[i] ELSE ((a[i]::DOUBLE + b[i]::DOUBLE) / 2)::FLOAT END)::DOUBLE * 1000000)::BIGINT), ',') AS fused FROM p""",
    "dual_vector_records": _records(False),
    "fused_vector_records": _records(True),
    "chunk_records_vs_vectors": f"""WITH {_AUDIO} SELECT 'raw/audio/' || event_id || '.wav' AS source_key, CASE WHEN event_id % 3 = 0 THEN {_spans("d", "30", "5")} ELSE 1 END::BIGINT AS records,
      CASE WHEN event_id % 3 = 0 THEN {_spans("d", "30", "5")} ELSE 0 END::BIGINT AS vectors FROM aur WHERE why IS NULL""",
    "topk_search": f"WITH {_SCORED} SELECT key, round(s, 6) AS score FROM v ORDER BY s DESC, key LIMIT 10",
    "topk_filtered": f"WITH {_SCORED} SELECT key, round(s, 6) AS score FROM v WHERE modality = 'audio' ORDER BY s DESC, key LIMIT 10",
    "topk_by_modality": f"WITH {_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY modality ORDER BY s DESC, key) AS n FROM v) SELECT modality, n::INTEGER AS rank, key, round(s, 6) AS score FROM r WHERE n <= 5",
    "manifest": f"WITH {_ENTRIES} SELECT s3_key, status, reason, n::INTEGER AS chunks_indexed FROM entry",
    "run_summary": f"WITH {_ENTRIES} SELECT count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped FROM entry",
    "quarantine_keys": f"""WITH {_ENTRIES} SELECT s3_key, 'quarantine/' || modality || '/' || s3_key AS quarantine_key, reason FROM entry
      WHERE status = 'failed' AND modality IS NOT NULL AND reason <> 'no_chunks_indexed'""",
    "quality_report": f"""WITH pg AS (SELECT {_CLEAN_HTML} AS x, {_EXT.format(k="url")} AS e FROM pages),
      t AS (SELECT {_CLEAN_TEXT} AS x FROM documents UNION ALL SELECT x FROM pg WHERE {_MODALITY.format(e="e")} = 'text'), c AS (SELECT c FROM {_chunks("t", "1 AS one", "x")})
      SELECT 'text' AS modality, count(*) AS chunks, count(*) FILTER (c = '') AS empty, count(*) FILTER (length(c) < 20) AS short, sum(length(c))::BIGINT AS chars, 0::BIGINT AS unindexed,
        sum({" + ".join(f"(length(c) - length(replace(c, '{m}', ''))) // {len(m)}" for _, m in _MARKS)})::BIGINT AS redactions FROM c""",
    "delete_by_modality": f"WITH {_SCORED} SELECT modality, count(*) AS \"left\", sum(key)::BIGINT AS keys FROM v WHERE modality NOT IN ('image', 'video') GROUP BY modality",
    "arrivals_by_day": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS arrivals FROM events GROUP BY ALL",
    "ingest_stream_dedup": "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type",
}
