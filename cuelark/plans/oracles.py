"""The queries of `registry` in DuckDB's SQL."""

WORDS = r"""
t AS (SELECT conv_id, turn, unnest(string_split_regex(text, '\s+')) AS w, generate_subscripts(string_split_regex(text, '\s+'), 1) AS pos FROM conversations),
n AS (SELECT conv_id, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn, pos) - 1 AS i FROM t WHERE w <> ''),
words AS (SELECT conv_id AS recording_id, i::INT AS i, CASE WHEN i % 17 = 5 THEN 'um,' WHEN i % 29 = 7 THEN 'Like' ELSE w END AS word,
  (400 * i) / 1000.0::DOUBLE AS start_time, (400 * i + least(380, 80 + 20 * length(w))) / 1000.0::DOUBLE AS end_time FROM n)"""
FILLER = """lower(trim(word, '.,!?;:"''')) IN ('um', 'uh', 'er', 'ah', 'like', 'you know', 'sort of', 'kind of')"""
SAME = """lower(trim(trim({0}, '.,!?;:"''')))"""


def segs(source: str, to: str) -> str:
    """Segments by pointers: the next split behind every word, and the chain of starts."""
    return f"""
{to}_w AS (SELECT *, sum(strlen(word)) OVER (PARTITION BY recording_id ORDER BY i) AS cum FROM {source}),
{to}_x AS (SELECT a.recording_id, a.i, min(b.i) AS nxt FROM {to}_w a JOIN {to}_w b ON a.recording_id = b.recording_id AND b.i BETWEEN a.i AND a.i + 60
  AND ((suffix(b.word, '.') OR suffix(b.word, '?') OR suffix(b.word, '!')) AND b.end_time - a.start_time > 0.5::DOUBLE
    OR b.end_time - a.start_time > 15::DOUBLE OR b.cum - a.cum + strlen(a.word) + (b.i - a.i) > 120) GROUP BY ALL),
{to}_r AS (SELECT recording_id, 0 AS i, 1 AS segment FROM {source} WHERE i = 0
  UNION ALL SELECT r.recording_id, x.nxt + 1, r.segment + 1 FROM {to}_r r JOIN {to}_x x ON x.recording_id = r.recording_id AND x.i = r.i
  JOIN {source} s ON s.recording_id = r.recording_id AND s.i = x.nxt + 1),
{to} AS (SELECT r.recording_id, r.segment, any_value(a.start_time) AS start_time, coalesce(max(CASE WHEN w.i = x.nxt THEN w.end_time END), 0) AS end_time,
  string_agg(w.word, ' ' ORDER BY w.i) AS text, count(*) AS n_words
  FROM {to}_r r LEFT JOIN {to}_x x ON x.recording_id = r.recording_id AND x.i = r.i JOIN {source} a ON a.recording_id = r.recording_id AND a.i = r.i
  JOIN {source} w ON w.recording_id = r.recording_id AND w.i >= r.i AND w.i <= coalesce(x.nxt, 2000000000) GROUP BY 1, 2)"""


def clock(x: str, mark: str) -> str:
    whole = f"trunc({x})::BIGINT"
    return f"printf('%02d:%02d:%02d{mark}%03d', floor({x} / 3600::DOUBLE)::BIGINT, floor({x} / 60::DOUBLE)::BIGINT % 60, {whole} % 60, trunc(({x} - {whole}) * 1000::DOUBLE)::BIGINT)"


SPOKEN = f"spoken AS (SELECT recording_id, row_number() OVER (PARTITION BY recording_id ORDER BY i) - 1 AS i, word, start_time, end_time FROM words WHERE NOT ({FILLER}))"
W = f"WITH RECURSIVE {WORDS}"
CUES = f"{W}, {SPOKEN}, {segs('spoken', 'seg')}"
CHUNKS = f"{W}, {segs('words', 'seg')}"
LINKS = f"""{CHUNKS}, links AS (SELECT c.recording_id, c.segment::BIGINT AS chunk_id, (w.i + 1)::BIGINT AS word_id,
  row_number() OVER (PARTITION BY c.recording_id, c.segment ORDER BY w.start_time, w.i) - 1 AS position
  FROM seg c JOIN words w ON w.recording_id = c.recording_id AND w.start_time >= c.start_time - 0.01::DOUBLE AND w.end_time <= c.end_time + 0.01::DOUBLE)"""
STATS = """SELECT recording_id, n_words, n_fillers, n_chunks, first_start, last_end FROM
  (SELECT recording_id, count(*) AS n_words, count(*) FILTER ({f}) AS n_fillers, min(start_time) AS first_start, max(end_time) AS last_end FROM {w} GROUP BY 1)
  JOIN (SELECT recording_id, count(*) AS n_chunks FROM {s} GROUP BY 1) USING (recording_id)"""
BASE = """base AS (SELECT recording_id, row_number() OVER (PARTITION BY recording_id ORDER BY i, k) - 1 AS i, word, start_time, end_time
  FROM words, (VALUES (0), (1)) v(k) WHERE i % 23 <> 0 AND (k = 0 OR i % 31 = 0))"""
RECORDINGS = "r AS (SELECT doc_id AS recording_id, 44 + coalesce(n_chars, 0) * 3200 AS size, coalesce(n_chars, 0) * 1600 AS n_frames, coalesce(n_chars, 0) * 3200 / 32000::DOUBLE AS duration FROM documents)"
EVENTS = f"""{W}, m AS (SELECT recording_id, max(end_time) AS mx FROM words GROUP BY 1),
k AS (SELECT recording_id, unnest(range(0, ceil(greatest(mx - 5, 0) / 4.5::DOUBLE)::BIGINT + 1)) AS sequence FROM m),
ev AS (SELECT k.recording_id AS session_id, sequence, 4.5::DOUBLE * sequence + 5.0::DOUBLE AS up_to, w.i, w.word,
  w.start_time + CASE WHEN sequence % 2 = 1 THEN 0.08::DOUBLE ELSE 0 END AS start_time, w.end_time + CASE WHEN sequence % 2 = 1 THEN 0.08::DOUBLE ELSE 0 END AS end_time
  FROM k JOIN words w ON w.recording_id = k.recording_id AND w.start_time >= 4.5::DOUBLE * sequence AND w.end_time <= 4.5::DOUBLE * sequence + 5.0::DOUBLE)"""
COMMITTED = f"""{EVENTS},
per AS (SELECT session_id, sequence, max(greatest(up_to, end_time)) AS top FROM ev GROUP BY ALL),
prior AS (SELECT session_id, sequence, coalesce(max(top) OVER (PARTITION BY session_id ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS last FROM per),
cand AS (SELECT ev.*, {SAME.format('word')} AS form FROM ev JOIN prior USING (session_id, sequence) WHERE trim(word) <> '' AND end_time > last + 0.05::DOUBLE),
kept AS (SELECT a.* FROM cand a WHERE NOT EXISTS (SELECT 1 FROM cand b WHERE b.session_id = a.session_id AND b.form = a.form
  AND (b.sequence < a.sequence OR b.sequence = a.sequence AND b.i < a.i) AND abs(b.start_time - a.start_time) <= 0.35::DOUBLE AND abs(b.end_time - a.end_time) <= 0.35::DOUBLE))"""
SESSIONS = """WITH s0 AS (SELECT user_id::VARCHAR AS session_id, event_id, ts, value,
  CASE event_type WHEN 'signup' THEN 'start' WHEN 'view' THEN 'audio' WHEN 'click' THEN 'audio' WHEN 'error' THEN 'flush' WHEN 'purchase' THEN 'stop' ELSE event_type END AS type,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS arrival FROM events),
s AS (SELECT *, arrival AS sequence, arrival * 0.5::DOUBLE AS pts, arrival % 3 * 16000 AS n_bytes,
  coalesce(sum(CASE WHEN type IN ('flush', 'stop') THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS span FROM s0)"""
CONCAT = f"""{W}, d AS (SELECT recording_id, max(end_time) AS duration FROM words GROUP BY 1),
b AS (SELECT recording_id, duration, unnest(range(0, floor(duration)::INT, 60)) AS start FROM d),
c AS (SELECT b.recording_id, b.start // 60 AS chunk_index, w.i, w.word, w.start_time, w.end_time FROM b JOIN words w ON w.recording_id = b.recording_id
  AND w.start_time >= b.start AND w.start_time < least(b.start + 62, duration))"""

SQL = {
    "filler_flags": f"{W} SELECT recording_id, i, word, {FILLER} AS is_filler FROM words",
    "filler_filter": f"{W} SELECT * FROM words WHERE NOT ({FILLER})",
    "word_normal_forms": rf"""{W} SELECT recording_id, i, {SAME.format('word')} AS same_form,
        regexp_replace(regexp_replace(lower(word), '^[^\p{{L}}\p{{N}}]+', ''), '[^\p{{L}}\p{{N}}]+$', '') AS diff_form, strlen(word)::INT AS n_bytes FROM words""",
    "srt_cues": f"""{CUES} SELECT recording_id, segment::INT AS segment, concat(segment, chr(10), {clock('start_time', ',')}, ' --> ', {clock('end_time', ',')}, chr(10), text, chr(10)) AS cue FROM seg""",
    "vtt_cues": f"""{CUES} SELECT recording_id, segment::INT AS segment, concat({clock('start_time', '.')}, ' --> ', {clock('end_time', '.')}, chr(10), text, chr(10)) AS cue FROM seg""",
    "txt_lines": f"{CUES} SELECT recording_id, segment::INT AS segment, text FROM seg",
    "chunk_words": f"{LINKS} SELECT recording_id, chunk_id, word_id, position::INT AS position FROM links",
    "words_backfilled": f"""{LINKS} SELECT w.recording_id, (w.i + 1)::BIGINT AS word_id, word, start_time, end_time, end_time - start_time AS duration, {FILLER} AS is_filler,
        false AS is_removed, l.chunk_id FROM words w LEFT JOIN (SELECT recording_id, word_id, max(chunk_id) AS chunk_id FROM links GROUP BY ALL) l ON l.recording_id = w.recording_id AND l.word_id = w.i + 1""",
    "chunk_stats": f"{CHUNKS} SELECT recording_id, segment::BIGINT AS chunk_id, start_time, end_time, end_time - start_time AS duration, n_words::INT AS word_count, 'auto' AS source_type FROM seg",
    "transcript_stats": f"{CHUNKS} {STATS.format(f='WHERE ' + FILLER, w='words', s='seg')}",
    "edge_words": f"""{W}, r AS (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY start_time, i) AS a, row_number() OVER (PARTITION BY recording_id ORDER BY end_time DESC, i DESC) AS b FROM words)
        SELECT recording_id, string_agg(word, ' ' ORDER BY a) FILTER (WHERE a <= 10) AS first_words, string_agg(word, ' ' ORDER BY b DESC) FILTER (WHERE b <= 10) AS last_words FROM r GROUP BY 1""",
    "run_delta": f"""{CHUNKS}, {BASE}, {segs('base', 'bseg')}, x AS ({STATS.format(f='WHERE ' + FILLER, w='words', s='seg')}), y AS ({STATS.format(f='WHERE ' + FILLER, w='base', s='bseg')})
        SELECT recording_id, coalesce(x.n_words, 0) - coalesce(y.n_words, 0) AS delta_words, coalesce(x.n_chunks, 0) - coalesce(y.n_chunks, 0) AS delta_chunks,
        coalesce(x.last_end - x.first_start, 0) - coalesce(y.last_end - y.first_start, 0) AS delta_coverage FROM x FULL JOIN y USING (recording_id)""",
    "recording_inventory": f"WITH {RECORDINGS} SELECT recording_id, size, duration, ceil(duration / 60::DOUBLE)::BIGINT AS n_chunks FROM r",
    "batch_windows": f"""WITH {RECORDINGS}, w AS (SELECT recording_id, duration, unnest(range(0, floor(duration)::INT, 60)) AS start FROM r)
        SELECT recording_id, (start // 60)::INT AS chunk_index, start::INT AS start, least(start + 62, duration)::DOUBLE AS "end" FROM w""",
    "overlap_windows": f"""WITH {RECORDINGS}, w AS (SELECT recording_id, n_frames, unnest(range(0, CASE WHEN n_frames <= 0 THEN 0 WHEN n_frames <= 80000 THEN 1
        ELSE 1 + ceil((n_frames - 80000) / 72000::DOUBLE)::BIGINT END)) AS sequence FROM r)
        SELECT recording_id, sequence, sequence * 72000 AS first_frame, least(80000, n_frames - sequence * 72000) AS frames, sequence * 72000 / 16000::DOUBLE AS start,
        least(80000, n_frames - sequence * 72000) / 16000::DOUBLE AS duration FROM w""",
    "window_words_concat": f"{CONCAT} SELECT recording_id, chunk_index::INT AS chunk_index, i, word, start_time, end_time FROM c",
    "batch_totals": f"""{CONCAT} SELECT d.recording_id, d.duration AS total_duration, count(DISTINCT chunk_index) AS chunk_count, count(c.i) AS word_count FROM d LEFT JOIN c USING (recording_id) GROUP BY 1, 2""",
    "char_words": """WITH c AS (SELECT conv_id AS recording_id, turn AS chunk_index, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) - 1 AS p FROM conversations),
        g AS (SELECT *, sum(CASE WHEN ch = ' ' THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id, chunk_index ORDER BY p) AS island FROM c)
        SELECT recording_id, chunk_index, island::BIGINT AS island, string_agg(ch, '' ORDER BY p) AS word, round(min(p) * 0.08::DOUBLE + chunk_index * 60.0::DOUBLE, 3) AS start_time,
        round((max(p) + 1) * 0.08::DOUBLE + chunk_index * 60.0::DOUBLE, 3) AS end_time FROM g WHERE ch <> ' ' GROUP BY 1, 2, 3 HAVING trim(string_agg(ch, '' ORDER BY p)) <> ''""",
    "stamp_words": f"""{W} SELECT recording_id, (i // 750)::BIGINT AS chunk_index, (i % 750)::INT AS position, word, round((i % 750) * 5 * 0.08::DOUBLE + (i // 750) * 300.0::DOUBLE, 3) AS start_time,
        round(((i % 750) * 5 + 4) * 0.08::DOUBLE + (i // 750) * 300.0::DOUBLE, 3) AS end_time FROM words""",
    "accumulated_final": f"{COMMITTED} SELECT session_id, sequence, word, start_time, end_time FROM kept",
    "event_deltas": f"""{COMMITTED}, e AS (SELECT DISTINCT session_id, sequence FROM ev), g AS (SELECT session_id, sequence, count(*) AS n FROM kept GROUP BY ALL)
        SELECT e.session_id, e.sequence AS arrival, e.sequence, coalesce(n, 0) AS delta, sum(coalesce(n, 0)) OVER (PARTITION BY e.session_id ORDER BY e.sequence)::BIGINT AS committed FROM e LEFT JOIN g USING (session_id, sequence)""",
    "preview_changes": f"""{COMMITTED}, o AS (SELECT *, row_number() OVER (PARTITION BY session_id, sequence ORDER BY i) AS rn FROM ev),
        pend AS (SELECT o.* FROM o JOIN prior USING (session_id, sequence) WHERE rn <= 2 AND trim(o.word) <> '' AND o.end_time > last + 0.05::DOUBLE AND NOT EXISTS (
          SELECT 1 FROM kept b WHERE b.session_id = o.session_id AND b.sequence < o.sequence AND b.form = {SAME.format('o.word')} AND abs(b.start_time - o.start_time) <= 0.35::DOUBLE AND abs(b.end_time - o.end_time) <= 0.35::DOUBLE)
          AND NOT EXISTS (SELECT 1 FROM o b WHERE b.session_id = o.session_id AND b.sequence = o.sequence AND b.rn < o.rn AND b.end_time > last + 0.05::DOUBLE AND {SAME.format('b.word')} = {SAME.format('o.word')} AND abs(b.start_time - o.start_time) <= 0.35::DOUBLE AND abs(b.end_time - o.end_time) <= 0.35::DOUBLE)),
        p AS (SELECT e.session_id, e.sequence, coalesce(string_agg(pend.word, ' ' ORDER BY pend.i), '') AS preview FROM (SELECT DISTINCT session_id, sequence FROM ev) e LEFT JOIN pend USING (session_id, sequence) GROUP BY ALL),
        l AS (SELECT *, coalesce(lag(preview) OVER (PARTITION BY session_id ORDER BY sequence), '') AS was FROM p) SELECT session_id, 2 * sequence AS arrival, sequence, preview FROM l WHERE preview <> '' AND preview <> was""",
    "sequence_errors": f"""{EVENTS}, f AS (SELECT DISTINCT session_id, sequence, 10 * sequence + CASE WHEN sequence % 3 = 1 THEN 12 ELSE 0 END AS base FROM ev),
        d AS (SELECT session_id, sequence, base AS arrival, true AS is_final FROM f UNION ALL SELECT session_id, sequence, base + 3, true FROM f WHERE sequence % 5 = 0
          UNION ALL SELECT session_id, sequence, base - 1, false FROM f WHERE sequence % 4 = 0 UNION ALL SELECT session_id, sequence, base + 4, false FROM f WHERE sequence % 7 = 0),
        seen AS (SELECT *, max(sequence) OVER w AS most, coalesce(bool_or(is_final) OVER (PARTITION BY session_id, sequence ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS done
          FROM d WINDOW w AS (PARTITION BY session_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT session_id, arrival, sequence, CASE WHEN sequence < most THEN 'out of order: ' || sequence || ' after ' || most ELSE 'already finalised: ' || sequence END AS error
        FROM seen WHERE sequence < most OR sequence = most AND done""",
    "session_totals": f"""{EVENTS} SELECT session_id, count(*) AS word_count, round(max(up_to) * 1000) / 1000 AS duration, max(end_time) AS last_word_end FROM ev GROUP BY 1""",
    "chunk_event_pairs": f"""{SESSIONS}, c AS (SELECT session_id, sequence, epoch_us(ts) / 1000.0::DOUBLE AS emitted, row_number() OVER (PARTITION BY session_id ORDER BY sequence) AS k FROM s WHERE type = 'audio'),
        e AS (SELECT session_id, event_id, epoch_us(ts) / 1000.0::DOUBLE AS received, row_number() OVER (PARTITION BY session_id ORDER BY epoch_us(ts), event_id) AS k FROM s WHERE type IN ('flush', 'stop'))
        SELECT e.session_id, e.event_id, coalesce(c.sequence, -1) AS sequence, received - emitted AS latency_ms FROM e LEFT JOIN c USING (session_id, k)""",
    "session_metrics": f"""{SESSIONS}, a AS (SELECT *, round(value)::BIGINT AS ms FROM s WHERE type = 'audio'), el AS (SELECT session_id, (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6::DOUBLE AS sec FROM s GROUP BY 1)
        SELECT session_id, count(*) AS chunks, arg_max(sequence * 2, sequence) AS committed_words, round(max(pts + 0.5::DOUBLE) * 1000) / 1000 AS audio_seconds, round(avg(ms) * 1000) / 1000 AS avg_server_ms, max(ms) AS max_server_ms, sum(ms)::BIGINT AS sum_server_ms,
        round(avg(ms * 2) * 1000) / 1000 AS avg_end_to_end_ms, max(ms * 2) AS max_end_to_end_ms,
        round(coalesce(CASE WHEN any_value(sec) > 0 THEN (round(max(pts + 0.5::DOUBLE) * 1000) / 1000) / any_value(sec) ELSE 0 END, 0) * 1000) / 1000 AS audio_per_wall_second FROM a JOIN el USING (session_id) GROUP BY 1""",
    "flush_spans": f"""{SESSIONS}, g AS (SELECT session_id, span, arg_min(pts, arrival) FILTER (WHERE type = 'audio' AND n_bytes > 0) AS first, coalesce(sum(n_bytes) FILTER (WHERE type = 'audio'), 0) AS n,
        max(type) FILTER (WHERE type IN ('flush', 'stop')) AS closed_by FROM s GROUP BY ALL),
        d AS (SELECT *, round(n / 32000::DOUBLE, 3) AS duration FROM g WHERE closed_by IS NOT NULL),
        f AS (SELECT *, coalesce(first, greatest(max(CASE WHEN first IS NOT NULL THEN round(first + duration, 3) END) OVER (PARTITION BY session_id ORDER BY span ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS start FROM d)
        SELECT session_id, span, start, duration, round(start + duration, 3) AS up_to, closed_by FROM f""",
    "partial_triggers": f"""{SESSIONS}, b AS (SELECT session_id, sequence, sum(n_bytes) OVER (PARTITION BY session_id, span ORDER BY arrival) / 32000::DOUBLE AS buffered FROM s WHERE type = 'audio')
        SELECT session_id, sequence, round(buffered * 1000) / 1000 AS buffered FROM b WHERE buffered >= 1""",
    "idle_sessions": f"""{SESSIONS}, l AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY session_id ORDER BY ts, arrival)) > 36000000000 THEN 1 ELSE 0 END AS brk FROM s),
        st AS (SELECT *, sum(brk) OVER (PARTITION BY session_id ORDER BY ts, arrival)::BIGINT AS stretch FROM l)
        SELECT session_id, stretch, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_events FROM st GROUP BY 1, 2""",
    "event_validation": f"""{SESSIONS.replace("WITH s0", "WITH RECURSIVE s0")}, x AS (SELECT session_id, event_id, type, arrival, value, event_id % 7 = 0 AS no_pts, CASE WHEN event_id % 11 = 0 THEN -1 ELSE value END AS duration,
          (coalesce(sum(CASE WHEN type = 'audio' AND event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 17 <> 0 AND value >= 0 THEN 1 ELSE 0 END)
            OVER (PARTITION BY session_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END)::BIGINT AS seq FROM s),
        ok AS (SELECT session_id, arrival, seq FROM x WHERE type = 'audio' AND NOT no_pts AND duration >= 0),
        nxt AS (SELECT a.session_id, a.arrival, a.seq, min(b.arrival) AS then FROM ok a LEFT JOIN ok b ON b.session_id = a.session_id AND b.seq = a.seq + 1 AND b.arrival > a.arrival GROUP BY ALL),
        taken AS (SELECT session_id, min(arrival) AS arrival, 0::BIGINT AS seq FROM ok WHERE seq = 0 GROUP BY 1
          UNION ALL SELECT t.session_id, n.then, t.seq + 1 FROM taken t JOIN nxt n ON n.session_id = t.session_id AND n.arrival = t.arrival AND n.seq = t.seq WHERE n.then IS NOT NULL),
        e AS (SELECT x.*, count(t.arrival) OVER (PARTITION BY x.session_id ORDER BY x.arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS expected
          FROM x LEFT JOIN taken t ON t.session_id = x.session_id AND t.arrival = x.arrival)
        SELECT session_id, event_id, type, CASE WHEN type NOT IN ('start', 'audio', 'flush', 'stop') THEN 'invalid-event-type' WHEN type = 'start' AND event_id % 13 = 0 THEN 'decoder-error'
        WHEN type = 'audio' AND seq <> expected THEN 'invalid-sequence' WHEN type = 'audio' AND no_pts THEN 'invalid-pts' WHEN type = 'audio' AND duration < 0 THEN 'invalid-duration' END AS code FROM e""",
    "downmix": """WITH x AS (SELECT vec_id AS recording_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS k FROM embeddings)
        SELECT recording_id, k // 2 AS frame, trunc(greatest(-32768, least(32767, avg(floor(v::DOUBLE * 200000)))))::INT AS value FROM x GROUP BY 1, 2""",
}
SQL |= dict.fromkeys(("stream_accumulated", "accumulated_in_parts", "accumulated_by_join"), SQL["accumulated_final"])
SQL |= {
    "stream_pairs": SQL["chunk_event_pairs"],
    "sequence_checks": SQL["sequence_errors"],
    "final_times": f"{COMMITTED} SELECT session_id, sequence, last AS last_final FROM prior",
    "long_segments": f"{CHUNKS} SELECT recording_id, segment::INT AS segment, start_time, end_time, text, n_words::INT AS n_words FROM seg",
    "stream_replay": f"{EVENTS} SELECT session_id, sequence, count(*)::INT AS n_words FROM ev GROUP BY ALL",
    "stream_summaries": f"""{COMMITTED}, g AS (SELECT session_id, sequence, count(*) AS n FROM kept GROUP BY ALL),
        c AS (SELECT e.session_id, e.sequence, coalesce(n, 0) AS n, 4.5::DOUBLE * e.sequence + 5.0::DOUBLE AS fin, 100 + e.sequence % 7 * 10 AS ms, 1000.0::DOUBLE * e.sequence AS emitted,
          1000.0::DOUBLE * e.sequence + 200 + e.sequence % 5 * 100 AS received FROM (SELECT DISTINCT session_id, sequence FROM ev) e LEFT JOIN g USING (session_id, sequence)),
        r AS (SELECT *, count(*) OVER w AS chunks, sum(n) OVER w::BIGINT AS committed_words, round(max(fin) OVER w * 1000) / 1000 AS audio_seconds, (received - min(emitted) OVER w) / 1000::DOUBLE AS elapsed,
          sum(ms) OVER w::BIGINT AS sum_server_ms, max(ms) OVER w::BIGINT AS max_server_ms, sum(received - emitted) OVER w AS late, max(received - emitted) OVER w AS max_end_to_end_ms
          FROM c WINDOW w AS (PARTITION BY session_id ORDER BY sequence))
        SELECT session_id, sequence, chunks, committed_words, audio_seconds, round(elapsed * 1000) / 1000 AS elapsed_seconds, CASE WHEN elapsed > 0 THEN round(audio_seconds / elapsed * 1000) / 1000 ELSE 0 END AS audio_per_wall_second,
        sum_server_ms, round(sum_server_ms / chunks::DOUBLE * 1000) / 1000 AS avg_server_ms, max_server_ms, round(late / chunks * 1000) / 1000 AS avg_end_to_end_ms, max_end_to_end_ms FROM r""",
}
