"""DuckDB oracle SQL for the registered queries (same column names).

Written independently of the Spark plans: DuckDB's own functions
(``strip_accents``, ``to_json``, ``list_*``, window functions) compute each
result.  RE2's ``\\s`` is ASCII-only, so Unicode whitespace is spelled out.
"""

from __future__ import annotations

from aspectflow.functions.text import VIETNAMESE_LETTERS
from aspectflow.plans.tables import (
    EPOCH_SECONDS_2024, FPS, HEAVY_WORDS, LEADERBOARD_K, PATIENCE, PREVIEW_ROWS, REVIEW_TOPIC, SAMPLE_ROWS, TABLES,
    TOP_WORDS,
)
from aspectflow.schemas import ASPECTS, DASHBOARD_SENTIMENTS, MAX_MESSAGE_BYTES, MAX_VOCAB

R = 9
WS = (r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
      r"\x{202f}\x{205f}\x{3000}")


def _label_case(expr: str) -> str:
    return (f"CASE {expr} WHEN 0 THEN 'NONE' WHEN 1 THEN 'NEG' WHEN 2 THEN 'POS' "
            f"WHEN 3 THEN 'NEU' ELSE 'NONE' END")


def _aspect_labels() -> str:
    cols = []
    for i, a in enumerate(ASPECTS):
        sl = f"list_slice(embedding, {4 * i + 1}, {4 * i + 4})"
        cols.append(f"{_label_case(f'list_position({sl}, list_max({sl})) - 1')} AS {a}")
    return f"SELECT vec_id, {', '.join(cols)} FROM embeddings"


def _sentiment_counts() -> str:
    parts = [f"SELECT '{a}' AS Aspect, '{s}' AS Sentiment, "
             f"CAST(count(*) FILTER (WHERE {a} = '{s}') AS BIGINT) AS \"Count\" FROM l"
             for a in ASPECTS for s in DASHBOARD_SENTIMENTS]
    return f"WITH l AS ({_aspect_labels()}) " + " UNION ALL ".join(parts)


def _clean(col: str = "text") -> str:
    stripped = f"regexp_replace(lower({col}), '^[{WS}]+|[{WS}]+$', '', 'g')"
    return f"regexp_replace({stripped}, '[^a-z{VIETNAMESE_LETTERS}0-9]+', ' ', 'g')"


_TOKENS = (f"WITH c AS (SELECT doc_id, {_clean()} AS t FROM documents), "
           "s AS (SELECT doc_id, string_split(t, ' ') AS parts FROM c), "
           "tok AS (SELECT doc_id, parts[i] AS token, i AS pos FROM s, "
           "LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i) WHERE parts[i] <> '') ")

_COUNTS = _TOKENS + (", cnts AS (SELECT token, count(*) AS cnt, "
                     "min(doc_id * 10000000 + pos) AS first FROM tok GROUP BY token) ")

_VOCAB = _COUNTS + (
    f", top AS (SELECT token, row_number() OVER (ORDER BY cnt DESC, first) AS rank FROM cnts "
    f"ORDER BY cnt DESC, first LIMIT {MAX_VOCAB}), "
    "vocab AS (SELECT '<PAD>' AS token, 0 AS id UNION ALL SELECT '<UNK>', 1 "
    "UNION ALL SELECT token, CAST(rank + 1 AS INTEGER) FROM top) ")

_ENCODED = _VOCAB + (
    ", enc AS (SELECT tok.doc_id, string_agg(CAST(coalesce(v.id, 1) AS VARCHAR), ' ' "
    "ORDER BY tok.pos) AS ids_text, count(*) AS n_ids, sum(coalesce(v.id, 1)) AS ids_sum "
    "FROM tok LEFT JOIN vocab v ON tok.token = v.token GROUP BY tok.doc_id), "
    "e AS (SELECT d.doc_id, coalesce(enc.ids_text, '') AS ids_text, "
    "CAST(coalesce(enc.n_ids, 0) AS INTEGER) AS n_ids, CAST(coalesce(enc.ids_sum, 0) AS BIGINT) "
    "AS ids_sum FROM documents d LEFT JOIN enc ON d.doc_id = enc.doc_id) ")

_PAIRS = (
    "WITH j AS (SELECT l.doc_id, d.source, CAST(l.quality + 1 AS INTEGER) AS tq, "
    "CAST(l.toxic + 1 AS INTEGER) AS tt, CAST(d.n_chars % 4 AS INTEGER) AS pq, "
    "CASE WHEN d.n_chars > 2000 THEN 2 ELSE 1 END AS pt "
    "FROM labels l JOIN documents d ON l.doc_id = d.doc_id), "
    "pairs AS (SELECT doc_id, source, 'quality' AS aspect, tq AS truth, pq AS pred FROM j "
    "UNION ALL SELECT doc_id, source, 'toxic', tt, pt FROM j) ")


def _class_sums(group: str = "") -> str:
    cols = []
    for c in range(4):
        cols += [f"sum(CASE WHEN truth = {c} AND pred = {c} THEN 1 ELSE 0 END) AS tp{c}",
                 f"sum(CASE WHEN truth = {c} THEN 1 ELSE 0 END) AS sup{c}",
                 f"sum(CASE WHEN pred = {c} THEN 1 ELSE 0 END) AS np{c}"]
    sel = (group + ", ") if group else ""
    tail = f" GROUP BY {group}" if group else ""
    return f"SELECT {sel}{', '.join(cols)} FROM pairs{tail}"


def _f1(c: int) -> str:
    return (f"(CASE WHEN sup{c} + np{c} > 0 THEN 2.0 * tp{c} / (sup{c} + np{c}) ELSE 0.0 END)")


def _macro_fixed() -> str:
    return "(" + " + ".join(_f1(c) for c in range(4)) + ") / 4.0"


def _masked_mean(vals, masks) -> str:
    num = " + ".join(f"(CASE WHEN {m} THEN {v} ELSE 0.0 END)" for v, m in zip(vals, masks))
    den = " + ".join(f"(CASE WHEN {m} THEN 1 ELSE 0 END)" for m in masks)
    return f"(CASE WHEN ({den}) > 0 THEN ({num}) / ({den}) ELSE 0.0 END)"


def _bal() -> str:
    return _masked_mean([f"(CAST(tp{c} AS DOUBLE) / sup{c})" for c in range(4)],
                        [f"sup{c} > 0" for c in range(4)])


def _macro_present() -> str:
    return _masked_mean([_f1(c) for c in range(4)], [f"sup{c} + np{c} > 0" for c in range(4)])


def _val_loss() -> str:
    heads = []
    for i in range(len(ASPECTS)):
        lg = f"list_transform(list_slice(embedding, {4 * i + 1}, {4 * i + 4}), lambda x: CAST(x AS DOUBLE))"
        m = f"list_max({lg})"
        heads.append(f"({m} + ln(list_sum(list_transform({lg}, lambda x: exp(x - {m})))) "
                     f"- {lg}[label % 4 + 1])")
    row = " + ".join(heads)
    return ("WITH r AS (SELECT vec_id, " + row + " AS row_ce, "
            "(row_number() OVER (ORDER BY vec_id) - 1) // 64 AS batch FROM embeddings), "
            f"b AS (SELECT batch, sum(row_ce) / (count(*) * {len(ASPECTS)}) AS bl FROM r GROUP BY batch) "
            f"SELECT round(avg(bl), {R}) AS val_loss, count(*) AS n_batches FROM b")


def _early_stop() -> str:
    return (
        "WITH h AS (SELECT user_id AS run, CAST(row_number() OVER (PARTITION BY user_id "
        "ORDER BY ts, event_id) AS INTEGER) AS epoch, value AS val_loss FROM events), "
        "p AS (SELECT *, min(val_loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN "
        "UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM h), "
        "f AS (SELECT *, (prior IS NULL OR val_loss < prior) AS improved FROM p), "
        "s AS (SELECT *, CAST(epoch - max(CASE WHEN improved THEN epoch END) OVER (PARTITION BY run "
        "ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS streak FROM f), "
        f"t AS (SELECT *, min(CASE WHEN streak >= {PATIENCE} THEN epoch END) OVER (PARTITION BY run) "
        "AS stop_epoch FROM s), "
        "u AS (SELECT * FROM t WHERE stop_epoch IS NULL OR epoch <= stop_epoch) "
        "SELECT run, max(stop_epoch) AS stop_epoch, "
        "max(CASE WHEN improved THEN epoch END) AS best_epoch, "
        "arg_max(val_loss, CASE WHEN improved THEN epoch END) AS best_loss, "
        "count(*) AS epochs_run FROM u GROUP BY run")


_DET = ("SELECT l_orderkey AS frame_id, l_linenumber AS class_id, "
        "CASE l_linenumber WHEN 2 THEN 'car' WHEN 3 THEN 'motorcycle' WHEN 5 THEN 'bus' "
        "WHEN 7 THEN 'truck' ELSE 'unknown' END AS label, l_discount AS conf, "
        "l_tax AS x1, l_discount AS y1, l_quantity AS x2, l_extendedprice AS y2 FROM lineitem")

_FRAME_COUNTS = (
    f"WITH det AS ({_DET}), c AS (SELECT frame_id, "
    "count(*) FILTER (WHERE label = 'car') AS car, count(*) FILTER (WHERE label = 'motorcycle') "
    "AS motorcycle, count(*) FILTER (WHERE label = 'bus') AS bus, count(*) FILTER (WHERE "
    "label = 'truck') AS truck FROM det WHERE class_id IN (2, 3, 5, 7) GROUP BY frame_id), "
    "fc AS (SELECT o.o_orderkey AS frame_id, CAST(coalesce(c.car, 0) AS INTEGER) AS car, "
    "CAST(coalesce(c.motorcycle, 0) AS INTEGER) AS motorcycle, CAST(coalesce(c.bus, 0) AS INTEGER) "
    "AS bus, CAST(coalesce(c.truck, 0) AS INTEGER) AS truck FROM orders o LEFT JOIN c "
    "ON o.o_orderkey = c.frame_id), "
    "fct AS (SELECT *, CAST(car + motorcycle + bus + truck AS INTEGER) AS total_count FROM fc) ")

_REGISTRY = _PAIRS + (
    ", sums AS (" + _class_sums("source") + "), "
    "cand AS (SELECT source, " + _macro_fixed() + " AS macro_f1, " + _bal() + " AS balanced_acc, "
    "CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) AS run_no FROM sums), "
    "pr AS (SELECT *, max(macro_f1) OVER (ORDER BY run_no ROWS BETWEEN UNBOUNDED PRECEDING AND "
    "1 PRECEDING) AS prior FROM cand), "
    "prom AS (SELECT * FROM pr WHERE macro_f1 > greatest(0.0, coalesce(prior, 0.0))), "
    "reg AS (SELECT CAST(row_number() OVER (ORDER BY run_no) AS BIGINT) AS id, macro_f1, "
    "balanced_acc FROM prom), "
    "registry AS (SELECT id, 'cnn_v' || id || '.pth' AS model_name, macro_f1, balanced_acc, "
    f"make_timestamp(({EPOCH_SECONDS_2024} + id * 3600) * 1000000) AS created_at FROM reg) ")


def _dataset_shape() -> str:
    parts = [f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, "
             f"(SELECT count(*) FROM information_schema.columns WHERE table_name = '{t}') AS n_cols"
             for t in TABLES]
    return " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    step = max(1, int(FPS))
    out = {
        "aspect_labels": _aspect_labels(),
        "sentiment_counts": _sentiment_counts(),
        "sentiment_totals": (f"WITH sc AS ({_sentiment_counts()}) SELECT Sentiment, "
                             "CAST(sum(\"Count\") AS BIGINT) AS \"Count\" FROM sc GROUP BY Sentiment"),
        "text_clean": f"SELECT doc_id, {_clean()} AS clean_text FROM documents",
        "tone_strip": "SELECT doc_id, strip_accents(text) AS plain_text FROM documents",
        "spaces_normal": (f"SELECT doc_id, regexp_replace({_clean()}, '^ | $', '', 'g') AS norm_text "
                          "FROM documents"),
        "token_counts": _COUNTS + "SELECT token, cnt FROM cnts",
        "top_words": _COUNTS + ("SELECT token, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, first) "
                                f"AS INTEGER) AS rank FROM cnts ORDER BY cnt DESC, first LIMIT {TOP_WORDS}"),
        "vocab_size": _COUNTS + (f"SELECT count(*) AS n_distinct, least(count(*), {MAX_VOCAB}) + 2 "
                                 "AS vocab_size FROM cnts"),
        "vocab_ids": _VOCAB + "SELECT token, id FROM vocab",
        "encode_docs": _ENCODED + "SELECT doc_id, ids_text, n_ids FROM e",
        "pad_docs": _ENCODED + ("SELECT doc_id, CAST(max(n_ids) OVER () AS INTEGER) AS padded_len, "
                                "CAST(max(n_ids) OVER () - n_ids AS INTEGER) AS n_pad, true AS prefix_ok, "
                                "CASE WHEN max(n_ids) OVER () > n_ids THEN 0 END AS pad_max, "
                                "ids_sum FROM e"),
        "label_shift": ("SELECT doc_id, quality + 1 AS quality, toxic + 1 AS toxic, "
                        + _label_case("quality + 1") + " AS quality_name, "
                        + _label_case("toxic + 1") + " AS toxic_name FROM labels"),
        "confusion": _PAIRS + "SELECT aspect, truth, pred, count(*) AS cnt FROM pairs GROUP BY ALL",
        "macro_f1": _PAIRS + f", sums AS ({_class_sums()}) SELECT round({_macro_fixed()}, {R}) "
                             "AS macro_f1 FROM sums",
        "balanced_acc": _PAIRS + f", sums AS ({_class_sums()}) SELECT round({_bal()}, {R}) "
                                 "AS balanced_acc FROM sums",
        "aspect_metrics": _PAIRS + (
            f", sums AS ({_class_sums('aspect')}), m AS (SELECT aspect, {_macro_present()} AS f1, "
            f"{_bal()} AS bal_acc, CASE aspect WHEN 'quality' THEN 1 ELSE 2 END AS ai FROM sums) "
            f"SELECT aspect, round(f1, {R}) AS f1, round(bal_acc, {R}) AS bal_acc, "
            "CAST(row_number() OVER (ORDER BY f1, ai) AS INTEGER) AS rank FROM m"),
        "val_loss": _val_loss(),
        "early_stop": _early_stop(),
        "early_stop_scan": _early_stop(),
        "sample_frames": (f"SELECT replace(event_type || '_topic', '_topic', '') AS source_video, "
                          f"event_id AS frame_id, CAST(event_id // {step} AS BIGINT) AS video_second "
                          f"FROM events WHERE event_id % {step} = 0"),
        "frame_counts": _FRAME_COUNTS + "SELECT * FROM fct",
        "frame_json": _FRAME_COUNTS + (
            "SELECT frame_id, printf('{\"car\": %d, \"motorcycle\": %d, \"bus\": %d, \"truck\": %d}', "
            "car, motorcycle, bus, truck) AS class_counts, total_count, total_count AS parsed_total "
            "FROM fct"),
        "frame_boxes": (f"WITH det AS ({_DET}) SELECT frame_id, CAST(count(*) AS INTEGER) AS n_boxes, "
                        "string_agg(printf('%s@%.4f[%.2f,%.2f,%.2f,%.2f]', label, conf, x1, y1, x2, y2), "
                        "';' ORDER BY conf DESC, label, x1, y1, x2, y2) AS boxes_text "
                        "FROM det WHERE class_id IN (2, 3, 5, 7) GROUP BY frame_id"),
        "resize_height": ("SELECT p_partkey, p_size AS width, p_retailprice AS height, "
                          "CASE WHEN p_size > 0 THEN CAST(floor(p_retailprice * (640.0 / p_size)) "
                          "AS INTEGER) END AS new_height FROM part"),
        "base64_roundtrip": ("SELECT doc_id, to_base64(encode(text)) AS b64, "
                             "decode(from_base64(to_base64(encode(text)))) = text AS roundtrip_ok "
                             "FROM documents"),
        "json_parse": ("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events "
                       "WHERE CAST(json_extract(props, '$.k') AS INTEGER) IS NOT NULL"),
        "review_messages": (f"SELECT doc_id, '{REVIEW_TOPIC}' AS topic, "
                            "CAST(to_json({'review': text}) AS VARCHAR) AS value, "
                            "octet_length(encode(CAST(to_json({'review': text}) AS VARCHAR))) AS n_bytes, "
                            "octet_length(encode(CAST(to_json({'review': text}) AS VARCHAR))) <= "
                            f"{MAX_MESSAGE_BYTES} AS within_limit FROM documents"),
        "latest_frame": ("SELECT event_type, event_id, epoch_us(ts) AS ts_us, value FROM events QUALIFY "
                         "row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1"),
        "union_cameras": "SELECT event_type AS source_video, event_id AS frame_id, value FROM events",
        "promotion": _REGISTRY + (
            f"SELECT id, model_name, round(macro_f1, {R}) AS macro_f1, round(balanced_acc, {R}) "
            "AS balanced_acc, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM registry"),
        "csv_splits": ("SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, doc_id, md5(coalesce(text, '')) AS text_md5, n_chars "
                       "FROM documents"),
        "heavy_words": _COUNTS + ("SELECT token, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, first) "
                                  f"AS INTEGER) AS rank FROM cnts ORDER BY cnt DESC, first LIMIT {HEAVY_WORDS}"),
        "sample_sketch": ("SELECT doc_id, source, n_chars, md5('7/=' || doc_id::VARCHAR) AS sample_hash FROM documents "
                          f"ORDER BY sample_hash LIMIT {SAMPLE_ROWS}"),
        "length_batches": _ENCODED + ("SELECT count(*) AS n_rows, sum(n_ids)::BIGINT AS n_ids, true AS full_but_last, "
                                      "true AS padded_to_longest, true AS little_padding FROM e"),
        "frame_variant": _FRAME_COUNTS + (
            "SELECT frame_id, " + ", ".join(f"CAST(CASE WHEN frame_id % 7 = 0 THEN 0 ELSE {n} END AS INTEGER) AS {n}"
                                            for n in ("car", "motorcycle", "bus", "truck"))
            + ", CAST(CASE WHEN frame_id % 7 = 0 THEN 0 ELSE total_count END AS INTEGER) AS total FROM fct"),
        "registry_race": _REGISTRY + (f"SELECT round(max(macro_f1), {R}) AS best_f1, true AS ids_dense, true AS rising, "
                                      "true AS each_win_stored, true AS names_match FROM cand"),
        "leaderboard": _REGISTRY + (
            "SELECT id AS \"ID\", model_name AS \"Model Name\", round_even(macro_f1, 4) AS \"Macro F1\", "
            "round_even(balanced_acc, 4) AS \"Balanced Acc\", strftime(created_at, '%Y-%m-%d %H:%M:%S') "
            "AS \"Created At\" FROM registry ORDER BY macro_f1 DESC NULLS LAST, created_at DESC "
            f"LIMIT {LEADERBOARD_K}"),
        "best_model": _REGISTRY + (f"SELECT id, model_name, round(macro_f1, {R}) AS macro_f1 FROM registry "
                                   "ORDER BY macro_f1 DESC, id DESC LIMIT 1"),
        "preview": (f"SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id "
                    f"LIMIT {PREVIEW_ROWS}"),
        "dataset_shape": _dataset_shape(),
        **_streams(),
        **_models(),
        **_more(),
    }
    # tables that streams keep equal the tables computed at once
    return out | {"stream_grid_state": out["sentiment_counts"], "stream_latest_state": out["latest_frame"],
                  "committed_sink": out["catalog_sink"]}


def _more() -> dict[str, str]:
    step = max(1, int(FPS))
    frames = (f"SELECT event_type || '_topic' AS topic, event_id AS frame_id, "
              f"event_id // {step} AS video_second, props FROM events WHERE event_id % {step} = 0")
    message = ("CAST(to_json({'frame_id': CAST(frame_id AS INTEGER), 'video_second': "
               "CAST(video_second AS INTEGER), 'image_b64': to_base64(encode(props)), "
               "'source_video': replace(topic, '_topic', '')}) AS VARCHAR)")
    aspects = " UNION ALL ".join(f"SELECT vec_id, '{a}' AS aspect, {a} AS sentiment FROM l"
                                 for a in ASPECTS)
    return {
        "keep_vietnamese": ("SELECT doc_id, regexp_replace(text, '[^a-z" + VIETNAMESE_LETTERS
                            + "0-9" + WS + "]', ' ', 'g') AS kept_text FROM documents"),
        "raw_tokens": (
            f"WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[{WS}]+'), "
            "lambda x: x <> '') AS toks FROM documents) SELECT doc_id, CAST(len(toks) AS INTEGER) "
            "AS n_tokens, array_to_string(toks, ' ') AS tokens_text FROM t"),
        "aspect_values": f"WITH l AS ({_aspect_labels()}) {aspects}",
        "frame_messages": (f"WITH f AS ({frames}), m AS (SELECT topic, {message} AS value FROM f) SELECT topic, value, "
                           f"octet_length(encode(value)) AS n_bytes, octet_length(encode(value)) <= {MAX_MESSAGE_BYTES} "
                           "AS within_limit FROM m"),
        "random_sample": (f"SELECT least({SAMPLE_ROWS}, count(*)) AS n_rows, least({SAMPLE_ROWS}, count(*)) AS n_distinct, "
                          f"least({SAMPLE_ROWS}, count(*)) AS n_found FROM documents"),
        "pad_batches": _ENCODED + (
            ", b AS (SELECT doc_id, n_ids, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS batch FROM e) "
            "SELECT doc_id, batch, n_ids, max(n_ids) OVER (PARTITION BY batch) AS padded_len, true AS prefix_ok FROM b"),
        "counts_map": _FRAME_COUNTS + (
            "SELECT frame_id, printf('car=%d,motorcycle=%d,bus=%d,truck=%d', car, motorcycle, bus, truck) AS counts_text FROM fct"),
        "missing_aspect": "SELECT doc_id, 'quality' AS aspect, CAST(quality + 1 AS INTEGER) AS label FROM labels",
        "model_resolution": _REGISTRY + (
            ", best AS (SELECT model_name, macro_f1, id FROM registry ORDER BY macro_f1 DESC, id DESC LIMIT 1), "
            "found AS (SELECT r.model_name FROM best r WHERE r.model_name IN "
            "(SELECT model_name FROM registry WHERE model_name NOT IN (SELECT model_name FROM best))) "
            "SELECT coalesce((SELECT model_name FROM found), 'cnn_default.pth') AS model_name"),
        "catalog_sink": _FRAME_COUNTS.replace(
            "fc AS (SELECT o.o_orderkey AS frame_id,",
            "fc AS (SELECT o.o_orderpriority AS source_video, o.o_orderkey AS frame_id,")
        + "SELECT source_video, frame_id, total_count FROM fct",
        "frame_roundtrip": (f"WITH f AS ({frames}) SELECT replace(topic, '_topic', '') AS source_video, "
                            "CAST(frame_id AS INTEGER) AS frame_id, CAST(video_second AS INTEGER) "
                            "AS video_second, props AS image_text FROM f"),
        "recent_rows": (f"SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id DESC "
                        f"LIMIT {PREVIEW_ROWS}"),
        "current_best": _REGISTRY + f"SELECT round(coalesce(max(macro_f1), 0.0), {R}) AS best_f1 FROM registry",
        "encode_docs_join": _ENCODED + "SELECT doc_id, ids_text, n_ids FROM e",
        "frame_box_counts": (
            f"WITH det AS ({_DET}) SELECT frame_id, "
            + ", ".join(f"CAST(count(*) FILTER (WHERE label = '{n}') AS INTEGER) AS {n}"
                        for n in ["car", "motorcycle", "bus", "truck"])
            + ", CAST(count(*) FILTER (WHERE label IN ('car', 'motorcycle', 'bus', 'truck')) AS INTEGER) "
              "AS total_count FROM det WHERE class_id IN (2, 3, 5, 7) GROUP BY frame_id"),
        "batches": ("WITH b AS (SELECT vec_id, (row_number() OVER (ORDER BY vec_id) - 1) // 64 AS batch "
                    "FROM embeddings) SELECT batch, count(*) AS n_rows, min(vec_id) AS first_id, "
                    "max(vec_id) AS last_id FROM b GROUP BY batch"),
    }


def _models() -> dict[str, str]:
    from aspectflow.plans.ml_queries import ml_oracle_sql

    return ml_oracle_sql(_VOCAB)


def _streams() -> dict[str, str]:
    from aspectflow.plans.streams import stream_oracle_sql

    return stream_oracle_sql()
