"""DuckDB SQL for every registered query that SQL can express (the correctness oracle).

Views ``documents``, ``labels``, ``embeddings`` ... are registered by the
checker.  Regexes use the same explicit Unicode classes as the Spark side.
"""

from __future__ import annotations

from .functions.labels import SENTIMENT_NAMES, TASK_NAMES
from .functions.text import SYMBOL, WS
from .queries import (ABBREVIATION_LINES, EMOJI_ROWS, LOSS_WEIGHTS, MAX_LEN, PHRASE_DELTA, PHRASE_MAX_LEN, PHRASE_MIN_COUNT,
                      PHRASE_THRESHOLD, PROMPT_TEMPLATE, START_ROW)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x):
    return f"regexp_replace({x}, '^{WS}+|{WS}+\\z', '', 'g')"


def clean(x):
    return f"trim(regexp_replace(CAST({x} AS VARCHAR), '{WS}+', ' ', 'g'))"


def collapse(x):
    return f"regexp_replace({x}, '{WS}+', ' ', 'g')"


def symbols(x):
    return f"regexp_replace({x}, '{SYMBOL}', ' ', 'g')"


def tokens(x):
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda t: t <> '')"


def emoji(x):
    return (f"replace(replace(replace({x}, '\U0001F600', ':grinning_face:'), "
            f"'❤️', ':red_heart:'), '❤', ':red_heart:')")


def _dict():
    d = {}
    for _, k, v in sorted(ABBREVIATION_LINES):
        d[k] = v
    return d


def expand(x, d):
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in d.items())
    return f"array_to_string(list_transform({tokens(x)}, lambda w: CASE w {whens} ELSE w END), ' ')"


def pre_mt(x, d=None):
    y = f"lower({symbols(collapse(emoji(f"coalesce({x}, '')")))})"
    if d:
        y = expand(y, d)
    return strip(y)


def pre_se(x, d=None):
    y = f"lower({symbols(emoji(f"coalesce({x}, '')"))})"
    if d:
        y = expand(y, d)
    return y


def sentences(x):
    marked = f"regexp_replace({strip(x)}, '([.!?]){WS}+', '\\1' || chr(30), 'g')"
    return (f"list_filter(list_transform(string_split({marked}, chr(30)), lambda p: {strip('p')}), "
            f"lambda p: p <> '')")


def with_emoji(t="text"):
    return (f"CASE doc_id % 4 WHEN 0 THEN {t} || ' \U0001F600' WHEN 1 THEN '❤️' || {t} "
            f"ELSE {t} END")


def name_case(x, names):
    whens = " ".join(f"WHEN {k} THEN {q(v)}" for k, v in names.items())
    return f"coalesce(CASE {x} {whens} END, 'Unknown')"


LAB = """lab AS (
  SELECT d.doc_id, CAST(d.doc_id AS VARCHAR) AS id, d.text AS comment,
         CAST(CASE WHEN l.toxic = 1 THEN 0 WHEN l.quality = 1 THEN 2 ELSE 1 END AS INTEGER) AS label,
         CAST(CAST(substr(d.source, 4, 1000) AS INTEGER) % 9 + 1 AS INTEGER) AS task
  FROM documents d JOIN labels l USING (doc_id))"""

PRED = LAB + """, pred AS (
  SELECT *, CAST((label + CAST(doc_id % 5 = 0 AS INTEGER)) % 3 AS INTEGER) AS pred_label,
         CAST((task - 1 + CAST(doc_id % 7 = 0 AS INTEGER)) % 9 + 1 AS INTEGER) AS pred_task
  FROM lab)"""

BATCHES = f"""c AS (
  SELECT doc_id, {clean('doc_id')} AS id, {clean('text')} AS comment FROM documents),
r AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM c),
b AS (SELECT *, row_idx // 5 AS batch_id, CAST(row_idx % 5 AS INTEGER) AS pos FROM r)"""


def part_expr(comment, key):
    s = f"translate({comment}, '|()' || chr(10) || chr(13), '     ')"
    lab = f"CAST({key} % 3 AS VARCHAR)"
    tsk = f"CAST({key} % 9 + 1 AS VARCHAR)"
    k = f"({key} % 10)"
    return (f"CASE WHEN {k} < 5 THEN {s} || '(' || {lab} || '-' || {tsk} || ')' "
            f"WHEN {k} = 5 THEN {s} WHEN {k} = 6 THEN '' "
            f"WHEN {k} = 7 THEN {s} || '(2-1-3)' WHEN {k} = 8 THEN {s} || '(21)' "
            f"ELSE {s} || '(7-12)' END")


RESPONSES = BATCHES + f""",
parts AS (SELECT batch_id, pos, {part_expr('comment', 'doc_id')} AS part FROM b),
resp AS (
  SELECT batch_id,
         CASE WHEN batch_id % 11 = 3 THEN NULL
              WHEN batch_id % 11 = 5 THEN string_agg(part, '|' ORDER BY pos) || '|extra(1-1)'
              ELSE string_agg(part, '|' ORDER BY pos) END AS response
  FROM parts GROUP BY batch_id),
sr AS (
  SELECT batch_id,
         CASE WHEN response IS NULL THEN NULL
              WHEN {strip('response')} LIKE '%|%' THEN
                list_filter(list_transform(string_split({strip('response')}, '|'), lambda p: {strip('p')}),
                            lambda p: p <> '')
              ELSE [{strip('response')}] END AS parts
  FROM resp)"""


def parsed(src, part, fallback, extra_cols, on_null=None):
    """Three CTE layers: tag, pieces, labels.  ``fallback`` is the text kept when a
    part cannot be parsed, ``on_null`` the text kept when there is no part."""
    cols = ", ".join(extra_cols)
    on_null = on_null or fallback
    return f"""t1 AS (
  SELECT {cols}, {part} AS part, {fallback} AS fb, {on_null} AS nb,
         (strpos({part}, '(') > 0 AND strpos({part}, ')') > 0) AS hp,
         {strip(f"split_part({part}, '(', 1)")} AS corr,
         {strip(f"split_part(split_part({part}, '(', 2), ')', 1)")} AS tag
  FROM {src}),
t2 AS (SELECT *, string_split(tag, '-') AS pcs FROM t1),
t3 AS (
  SELECT {cols},
         CASE WHEN part IS NULL THEN nb WHEN NOT hp THEN fb WHEN len(pcs) <= 2 THEN corr ELSE fb END
           AS corrected_text,
         CASE WHEN part IS NOT NULL AND hp AND len(pcs) = 2 AND pcs[1] IN ('0', '1', '2') THEN pcs[1]
              ELSE '1' END AS label,
         CASE WHEN part IS NOT NULL AND hp AND len(pcs) = 2 AND regexp_full_match(pcs[2], '[1-9]') THEN pcs[2]
              ELSE '9' END AS task
  FROM t2)"""


def confusion_cte():
    return PRED + """,
pairs AS (
  SELECT 'sentiment' AS head, label AS actual, pred_label AS predicted FROM pred
  UNION ALL SELECT 'task', task, pred_task FROM pred),
grid AS (
  SELECT 'sentiment' AS head, CAST(x // 3 AS INTEGER) AS actual, CAST(x % 3 AS INTEGER) AS predicted, 0 AS n
  FROM range(0, 9) t(x)
  UNION ALL
  SELECT 'task', CAST(x // 9 + 1 AS INTEGER), CAST(x % 9 + 1 AS INTEGER), 0 FROM range(0, 81) t(x)),
cm AS (
  SELECT head, actual, predicted, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT head, actual, predicted, count(*) AS n FROM pairs GROUP BY ALL
    UNION ALL SELECT * FROM grid) GROUP BY ALL),
tp AS (SELECT head, actual AS cls, n AS tp FROM cm WHERE actual = predicted),
sup AS (SELECT head, actual AS cls, sum(n) AS support FROM cm GROUP BY ALL),
prd AS (SELECT head, predicted AS cls, sum(n) AS predicted_n FROM cm GROUP BY ALL),
pc0 AS (
  SELECT coalesce(sup.head, prd.head) AS head, coalesce(sup.cls, prd.cls) AS cls,
         coalesce(support, 0) AS support, coalesce(predicted_n, 0) AS predicted_n
  FROM sup FULL JOIN prd ON sup.head = prd.head AND sup.cls = prd.cls),
pc1 AS (
  SELECT pc0.*, coalesce(tp.tp, 0) AS tp FROM pc0 LEFT JOIN tp ON pc0.head = tp.head AND pc0.cls = tp.cls),
pc2 AS (
  SELECT *, CASE WHEN predicted_n = 0 THEN 0.0 ELSE tp / predicted_n END AS precision,
            CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM pc1),
pc AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pc2),
wm AS (
  SELECT head, sum(tp) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS precision,
         sum(recall * support) / sum(support) AS recall, sum(f1 * support) / sum(support) AS f1,
         CAST(sum(support) AS BIGINT) AS support
  FROM pc GROUP BY head)"""


SQL: dict[str, str] = {}

SQL["clean_comments"] = f"""
SELECT {clean('doc_id')} AS id, {clean('text')} AS comment, {clean('lang')} AS lang,
       {clean('source')} AS source, {clean('n_chars')} AS n_chars, '1' AS label, '9' AS task
FROM documents"""

SQL["preprocess_multitask"] = f"""
SELECT doc_id, {pre_mt(with_emoji(), _dict())} AS processed_text FROM documents"""

SQL["preprocess_sentiment"] = f"""
SELECT doc_id, {pre_se(with_emoji(), _dict())} AS processed_text FROM documents"""

SQL["demojize_text"] = f"""SELECT doc_id, {emoji(with_emoji())} AS text FROM documents"""

SQL["split_sentences"] = f"""
WITH s AS (SELECT doc_id, unnest(list_transform({sentences('text')}, lambda x, i: {{'i': i, 'x': x}})) AS u
           FROM documents)
SELECT doc_id, CAST(u.i - 1 AS INTEGER) AS sentence_no, u.x AS sentence FROM s"""

SQL["abbreviation_last_wins"] = f"""
WITH t AS (SELECT doc_id AS line_no, {clean('text')} AS t FROM documents)
SELECT lower(split_part(t, ' ', 1)) AS abbr, arg_max(split_part(t, ' ', 2), line_no) AS full
FROM t GROUP BY 1"""

SQL["prompt_batches"] = f"""
WITH {BATCHES}
SELECT batch_id, CAST(count(*) AS INTEGER) AS n_rows,
       {q(PROMPT_TEMPLATE)} || '"' || string_agg(replace(comment, '|', ' '), '|' ORDER BY pos) || '"' AS prompt
FROM b GROUP BY batch_id"""

SQL["parse_batch_responses"] = f"""
WITH {RESPONSES},
ex AS (SELECT batch_id, unnest(list_transform(parts, lambda x, i: {{'i': i, 'x': x}})) AS u FROM sr),
ex2 AS (SELECT batch_id, CAST(u.i - 1 AS INTEGER) AS part_no, u.x AS p FROM ex),
{parsed('ex2', 'p', 'p', ['batch_id', 'part_no'])}
SELECT batch_id, part_no, corrected_text, label, task FROM t3"""

SQL["align_responses"] = f"""
WITH {RESPONSES},
j AS (SELECT b.doc_id, b.id, b.comment, sr.parts[b.pos + 1] AS p FROM b LEFT JOIN sr USING (batch_id)),
{parsed('j', 'p', 'p', ['doc_id', 'id'], 'comment')}
SELECT doc_id, id, corrected_text AS comment, label, task FROM t3"""

SQL["labelled_counts"] = f"""
WITH {RESPONSES},
j AS (SELECT b.doc_id, b.id, b.comment, sr.parts[b.pos + 1] AS p FROM b LEFT JOIN sr USING (batch_id)),
{parsed('j', 'p', 'p', ['doc_id', 'id'], 'comment')}
SELECT CAST(label AS INTEGER) AS label, CAST(task AS INTEGER) AS task, count(*) AS n FROM t3 GROUP BY ALL"""

SQL["label_stream"] = SQL["align_responses"]

SQL["parse_single_responses"] = f"""
WITH c AS (SELECT doc_id, {clean('text')} AS comment FROM documents),
s AS (SELECT doc_id, unnest(list_transform({sentences('comment')}, lambda x, i: {{'i': i, 'x': x}})) AS u FROM c),
s2 AS (SELECT doc_id, CAST(u.i - 1 AS INTEGER) AS sentence_no, u.x AS sentence FROM s),
s3 AS (SELECT *, CASE WHEN (doc_id + sentence_no) % 11 = 3 THEN NULL
                      ELSE {part_expr('sentence', '(doc_id + sentence_no)')} END AS response FROM s2),
s4 AS (SELECT doc_id, sentence_no, sentence, {strip('response')} AS r FROM s3),
{parsed('s4', 'r', 'sentence', ['doc_id', 'sentence_no'])}
SELECT doc_id, sentence_no, corrected_text, label, task FROM t3"""

SQL["resume_by_id"] = """
SELECT doc_id, CAST(doc_id AS VARCHAR) AS id FROM documents
WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE doc_id IS NOT NULL)"""

SQL["resume_by_sentence"] = f"""
WITH s AS (SELECT doc_id, unnest(list_transform({sentences('text')}, lambda x, i: {{'i': i, 'x': x}})) AS u
           FROM documents),
s2 AS (SELECT doc_id, CAST(u.i - 1 AS INTEGER) AS sentence_no, u.x AS sentence FROM s),
done AS (SELECT DISTINCT sentence FROM s2 WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT doc_id, sentence_no, sentence FROM s2 WHERE sentence NOT IN (SELECT sentence FROM done)"""

SQL["skip_rows"] = f"""
SELECT doc_id, id, row_idx FROM (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx
  FROM documents) WHERE row_idx >= {START_ROW}"""

SOURCES = LAB + """,
a AS (SELECT doc_id, comment AS sentence, CASE WHEN doc_id % 50 = 7 THEN 5 ELSE label END AS sentiment
      FROM lab WHERE doc_id % 3 = 0),
b AS (SELECT doc_id, comment, CASE WHEN doc_id % 50 = 7 THEN 'BAD'
                                   ELSE CASE label WHEN 0 THEN 'NEG' WHEN 1 THEN 'NEU' WHEN 2 THEN 'POS' END
                              END AS label FROM lab WHERE doc_id % 3 = 1),
cc AS (SELECT doc_id, comment, CASE WHEN doc_id % 50 = 7 THEN 7
                                    ELSE CASE WHEN label = 0 THEN 0 WHEN label = 2 THEN 1 ELSE 9 END
                               END AS label FROM lab WHERE doc_id % 3 = 2)"""

SQL["recode_and_union"] = f"""
WITH {SOURCES}
SELECT doc_id, sentence AS text,
       CAST(CASE CAST(sentiment AS VARCHAR) WHEN '0' THEN 0 WHEN '1' THEN 1 WHEN '2' THEN 2 END AS INTEGER) AS label,
       'A' AS source FROM a
UNION ALL
SELECT doc_id, comment, CAST(CASE label WHEN 'NEG' THEN 0 WHEN 'NEU' THEN 1 WHEN 'POS' THEN 2 END AS INTEGER), 'B'
FROM b
UNION ALL
SELECT doc_id, comment, CAST(CASE CAST(label AS VARCHAR) WHEN '0' THEN 0 WHEN '1' THEN 2 END AS INTEGER), 'C'
FROM cc"""

SQL["validate_labels"] = f"""
WITH {SOURCES},
mixed AS (SELECT label, CAST(task AS BIGINT) AS task FROM lab
          UNION ALL SELECT sentiment, 9 FROM a
          UNION ALL SELECT label, doc_id % 11 FROM cc)
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE NOT coalesce(CAST(label AS VARCHAR) IN ('0', '1', '2'), false)) AS bad_label,
       count(*) FILTER (WHERE NOT coalesce(CAST(task AS VARCHAR) IN ('1','2','3','4','5','6','7','8','9'), false))
         AS bad_task
FROM mixed"""

SQL["decode_labels"] = f"""
WITH {PRED}
SELECT doc_id, {name_case('pred_label', SENTIMENT_NAMES)} AS sentiment_name,
       {name_case('pred_task', TASK_NAMES)} AS task_name,
       CAST(pred_task - 1 AS INTEGER) AS task_index,
       {name_case('label + 2', SENTIMENT_NAMES)} AS shifted_name
FROM pred"""

SQL["stratified_split_multitask"] = f"""
WITH {LAB},
r AS (SELECT id, label, task,
             row_number() OVER (PARTITION BY label, task ORDER BY md5('42:' || id), id) - 1 AS rk,
             count(*) OVER (PARTITION BY label, task) AS n FROM lab),
q AS (SELECT *, (n * 1500 + 5000) // 10000 AS tn FROM r)
SELECT id, label, task,
       CASE WHEN rk < tn THEN 'test' WHEN rk < tn + ((n - tn) * 3000 + 8500) // 17000 THEN 'val'
            ELSE 'train' END AS split
FROM q"""

SQL["stratified_split_sentiment"] = f"""
WITH {LAB},
r AS (SELECT id, label,
             row_number() OVER (PARTITION BY label ORDER BY md5('42:' || id), id) - 1 AS rk,
             count(*) OVER (PARTITION BY label) AS n FROM lab)
SELECT id, label,
       CASE WHEN rk < (n * 2000 + 10000) // 20000 THEN 'val' ELSE 'train' END AS split
FROM r"""

DOCS = f"""docs AS (SELECT doc_id, {pre_mt('text')} AS processed_text FROM documents),
toks AS (SELECT doc_id, {tokens('processed_text')} AS toks FROM docs)"""

VOCAB = DOCS + f""",
cnt AS (SELECT token, count(*) AS n FROM (SELECT unnest(toks) AS token FROM toks) GROUP BY token),
top AS (SELECT token, n FROM cnt),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token ASC) + 3 AS INTEGER) AS token_id, n
          FROM top)"""

SQL["fit_vocab"] = f"WITH {VOCAB} SELECT token, token_id, n FROM vocab"

SQL["encode_fixed"] = f"""
WITH {VOCAB},
t2 AS (SELECT doc_id, list_slice(toks, 1, {MAX_LEN - 2}) AS toks FROM toks),
ex AS (SELECT doc_id, unnest(list_transform(toks, lambda x, i: {{'i': i, 'x': x}})) AS u FROM t2),
ids AS (SELECT ex.doc_id, list(coalesce(v.token_id, 3) ORDER BY ex.u.i) AS ids
        FROM ex LEFT JOIN vocab v ON v.token = ex.u.x GROUP BY ex.doc_id),
f AS (SELECT t2.doc_id, coalesce(ids.ids, []::INTEGER[]) AS ids FROM t2 LEFT JOIN ids USING (doc_id))
SELECT doc_id,
       CAST(list_resize(list_concat([0], ids, [2]), {MAX_LEN}, 1) AS INTEGER[]) AS input_ids,
       CAST(list_resize(list_resize([1], len(ids) + 2, 1), {MAX_LEN}, 0) AS INTEGER[]) AS attention_mask
FROM f"""

PHRASES = DOCS + f""",
uni AS (SELECT w, count(*) AS n FROM (SELECT unnest(toks) AS w FROM toks) GROUP BY w),
bg AS (SELECT unnest(toks[1:len(toks) - 1]) AS a, unnest(toks[2:]) AS b FROM toks WHERE len(toks) > 1),
bi AS (SELECT a, b, count(*) AS n_ab FROM bg GROUP BY ALL HAVING count(*) >= {PHRASE_MIN_COUNT}),
sc AS (SELECT bi.a, bi.b, n_ab, ua.n AS n_a, ub.n AS n_b,
              (n_ab - {PHRASE_DELTA}) / (CAST(ua.n AS DOUBLE) * ub.n) AS score
       FROM bi JOIN uni ua ON ua.w = bi.a JOIN uni ub ON ub.w = bi.b)"""

SQL["phrase_scores"] = f"""
WITH {PHRASES}
SELECT a, b, n_ab, n_a, n_b, round(score * 1e6, 3) AS score FROM sc WHERE score > {PHRASE_THRESHOLD}"""

# greedy left-to-right joining: H/N flag per bigram position, 'H(.?)' -> 'S\1' marks the starts
SQL["apply_phrases"] = f"""
WITH {PHRASES},
ph AS (SELECT a || ' ' || b AS k FROM sc WHERE score > {PHRASE_THRESHOLD}),
bgp AS (SELECT doc_id, i, a || ' ' || b AS k FROM (
          SELECT doc_id, unnest(range(1, len(toks))) AS i, unnest(toks[1:len(toks) - 1]) AS a, unnest(toks[2:]) AS b
          FROM toks WHERE len(toks) > 1)),
hits AS (SELECT bgp.doc_id, string_agg(CASE WHEN ph.k IS NULL THEN 'N' ELSE 'H' END, '' ORDER BY bgp.i) AS flags
         FROM bgp LEFT JOIN ph ON bgp.k = ph.k GROUP BY bgp.doc_id),
f AS (SELECT t.doc_id, t.toks, regexp_replace(coalesce(h.flags, '') || 'N', 'H(.?)', 'S\1', 'g') AS st
      FROM toks t LEFT JOIN hits h USING (doc_id))
SELECT doc_id,
       array_to_string(list_filter(list_transform(toks, lambda x, i:
           CASE WHEN substr(st, i, 1) = 'S' THEN x || '_' || toks[i + 1]
                WHEN i > 1 AND substr(st, i - 1, 1) = 'S' THEN NULL ELSE x END),
         lambda y: y IS NOT NULL), ' ') AS phrased
FROM f"""

SQL["confusion_matrix"] = f"WITH {confusion_cte()} SELECT head, actual, predicted, n FROM cm"

SQL["classification_report"] = f"""
WITH {confusion_cte()},
pcs AS (SELECT * FROM pc WHERE support > 0 OR predicted_n > 0)
SELECT head, CAST(cls AS VARCHAR) AS row, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pcs
UNION ALL
SELECT head, 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT)
FROM pcs GROUP BY head
UNION ALL
SELECT head, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM pcs GROUP BY head
UNION ALL
SELECT head, 'weighted avg', round(precision, 6), round(recall, 6), round(f1, 6), support FROM wm"""

SQL["weighted_metrics"] = f"""
WITH {confusion_cte()}
SELECT head, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, support FROM wm"""

PROBS = """e AS (
  SELECT vec_id, list_transform(embedding[1:3], lambda v: CAST(v AS DOUBLE)) AS s,
         list_transform(embedding[4:12], lambda v: CAST(v AS DOUBLE)) AS t,
         CAST(label % 3 AS INTEGER) AS al, CAST(label % 9 + 1 AS INTEGER) AS act FROM embeddings),
x AS (SELECT *, list_transform(s, lambda v: exp(v - list_max(s))) AS es,
             list_transform(t, lambda v: exp(v - list_max(t))) AS et FROM e),
p AS (SELECT *, list_transform(es, lambda v: v / list_sum(es)) AS ps,
             list_transform(et, lambda v: v / list_sum(et)) AS pt FROM x)"""

SQL["mean_loss"] = f"""
WITH {PROBS}
SELECT round(avg(CASE WHEN vec_id % 50 = 7 THEN -ln(1e-15) WHEN vec_id % 50 <> 9 THEN -ln(ps[al + 1]) END), 6) AS sentiment_loss,
       round(avg(-ln(pt[act])), 6) AS task_loss,
       count(*) FILTER (vec_id % 50 = 9) AS sentiment_unscorable, CAST(0 AS BIGINT) AS task_unscorable FROM p"""

SQL["joint_loss"] = f"""
WITH {PROBS}
SELECT round({LOSS_WEIGHTS[0]} * avg(-ln(ps[al + 1])) + {LOSS_WEIGHTS[1]} * avg(-ln(pt[act])), 6) AS joint_loss
FROM p"""

SQL["predict_codes"] = f"""
WITH {PROBS}
SELECT CAST(vec_id AS VARCHAR) AS id_text, CAST(list_position(ps, list_max(ps)) - 1 AS INTEGER) AS sentiment,
       round(list_max(ps), 6) AS sentiment_confidence,
       CAST(list_position(pt, list_max(pt)) AS INTEGER) AS task, round(list_max(pt), 6) AS task_confidence
FROM p"""

SQL["predict_named"] = f"""
WITH {PROBS}
SELECT CAST(vec_id AS VARCHAR) AS text,
       {name_case('list_position(ps, list_max(ps)) - 1', SENTIMENT_NAMES)} AS sentiment,
       round(list_max(ps), 6) AS sentiment_confidence,
       {name_case('list_position(pt, list_max(pt))', TASK_NAMES)} AS task,
       round(list_max(pt), 6) AS task_confidence
FROM p"""

SQL["predict_emotion"] = f"""
WITH {PROBS}
SELECT CAST(vec_id AS VARCHAR) AS text,
       {name_case('list_position(ps, list_max(ps)) - 1', SENTIMENT_NAMES)} AS emotion,
       round(list_max(ps), 6) AS confidence
FROM p"""

SQL["score_with_batch_udf"] = """
WITH e AS (
  SELECT vec_id, [CAST(embedding[1] AS DOUBLE) + CAST(embedding[4] AS DOUBLE),
                  CAST(embedding[2] AS DOUBLE) + CAST(embedding[5] AS DOUBLE),
                  CAST(embedding[3] AS DOUBLE) + CAST(embedding[6] AS DOUBLE)] AS l FROM embeddings),
x AS (SELECT *, list_transform(l, lambda v: exp(v - list_max(l))) AS el FROM e),
p AS (SELECT vec_id, list_transform(el, lambda v: v / list_sum(el)) AS pr FROM x)
SELECT vec_id, CAST(list_position(pr, list_max(pr)) - 1 AS INTEGER) AS pred, round(list_max(pr), 6) AS confidence
FROM p"""

SQL["shuffle_order"] = f"""
WITH {LAB}
SELECT id, row_number() OVER (ORDER BY md5('42:' || id), id) - 1 AS order_idx FROM lab"""

SQL["dataset_counts"] = SQL["recode_and_union"].replace("WITH ", "WITH u0 AS (WITH ", 1) + """)
SELECT source, count(*) AS n_rows, count(DISTINCT label) AS n_classes FROM u0 GROUP BY source"""

SQL["prompt_sentences"] = f"""
WITH c AS (SELECT doc_id, {clean('text')} AS comment FROM documents),
s AS (SELECT doc_id, unnest(list_transform({sentences('comment')}, lambda x, i: {{'i': i, 'x': x}})) AS u FROM c),
s2 AS (SELECT doc_id, CAST(u.i - 1 AS INTEGER) AS sentence_no, u.x AS sentence FROM s),
done AS (SELECT DISTINCT sentence FROM s2 WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT doc_id, sentence_no, {q(PROMPT_TEMPLATE)} || '"' || sentence || '"' AS prompt
FROM s2 WHERE sentence NOT IN (SELECT sentence FROM done)"""

SQL["score_stream"] = SQL["predict_codes"]

SQL["label_stream_timeout"] = f"""
WITH {RESPONSES.replace("batch_id % 11 = 3", "batch_id % 11 IN (3, 7)")},
j AS (SELECT b.doc_id, b.id, b.comment, sr.parts[b.pos + 1] AS p, sr.parts IS NOT NULL AS answered
      FROM b LEFT JOIN sr USING (batch_id)),
{parsed('j', 'p', 'p', ['doc_id', 'id', 'answered'], 'comment')}
SELECT doc_id, id, corrected_text AS comment, label, task, answered FROM t3"""



def _grams(k):
    parts = ", ".join(f"unnest(toks[{j + 1}:len(toks) - {k - 1 - j}]) AS w{j}" for j in range(k))
    return (f"SELECT doc_id, pos, {k} AS n_tokens, {" || ' ' || ".join(f'w{j}' for j in range(k))} AS phrase FROM ("
            f"SELECT doc_id, unnest(range(0, len(toks) - {k - 1})) AS pos, {parts} FROM toks WHERE len(toks) >= {k})")


LONG_PHRASES = f"""docs AS (SELECT doc_id, {pre_se(with_emoji(), _dict())} AS processed_text FROM documents),
toks AS MATERIALIZED (SELECT doc_id, {tokens('processed_text')} AS toks FROM docs),
g AS MATERIALIZED ({" UNION ALL ".join(_grams(k) for k in range(1, PHRASE_MAX_LEN + 1))}),
cnt AS MATERIALIZED (
  SELECT phrase, n_tokens, count(*) AS n FROM g GROUP BY ALL HAVING count(*) >= {PHRASE_MIN_COUNT}),
spl AS (SELECT phrase, n_tokens, n, string_split(phrase, ' ') AS w, unnest(range(1, n_tokens)) AS k FROM cnt WHERE n_tokens > 1),
ph AS MATERIALIZED (
  SELECT s.phrase, s.n_tokens, s.n, min((s.n - {PHRASE_DELTA}) / (CAST(l.n AS DOUBLE) * r.n)) AS score
  FROM spl s JOIN cnt l ON l.phrase = array_to_string(s.w[1:s.k], ' ')
             JOIN cnt r ON r.phrase = array_to_string(s.w[s.k + 1:], ' ')
  GROUP BY ALL HAVING min((s.n - {PHRASE_DELTA}) / (CAST(l.n AS DOUBLE) * r.n)) > {PHRASE_THRESHOLD})"""

SQL["long_phrases"] = f"""
WITH {LONG_PHRASES}
SELECT phrase, CAST(n_tokens AS INTEGER) AS n_tokens, n, round(score * 1e6, 3) AS score FROM ph"""

# the scan as a fold: a match that begins behind the one taken before is taken
SQL["segment_sentiment"] = f"""
WITH {LONG_PHRASES},
hits AS (SELECT doc_id, pos, max(g.n_tokens) AS n FROM g JOIN ph USING (phrase) GROUP BY ALL),
m AS (
  SELECT doc_id, list({{'at': pos, 'n': n, 'free': 0::BIGINT, 'taken': []::STRUCT(s BIGINT, "at" BIGINT, n BIGINT)[]}} ORDER BY pos) AS ms
  FROM hits GROUP BY doc_id),
f AS (
  SELECT doc_id, list_reduce(list_concat([{{'at': 0::BIGINT, 'n': 0::BIGINT, 'free': 0::BIGINT,
                                            'taken': []::STRUCT(s BIGINT, "at" BIGINT, n BIGINT)[]}}], ms),
    lambda acc, h: CASE WHEN h."at" >= acc.free THEN {{'at': h."at", 'n': h.n, 'free': h."at" + h.n,
        'taken': list_append(acc.taken, {{'s': acc.free, 'at': h."at", 'n': h.n}})}} ELSE acc END) AS r
  FROM m),
w AS (SELECT t.doc_id, toks, coalesce(r.taken, []) AS taken, coalesce(r.free, 0) AS free FROM toks t LEFT JOIN f USING (doc_id))
SELECT doc_id, array_to_string(list_filter(list_concat(
    flatten(list_transform(taken, lambda c: [array_to_string(toks[c.s + 1:c."at"], ' '), array_to_string(toks[c."at" + 1:c."at" + c.n], '_')])),
    [array_to_string(toks[free + 1:], ' ')]), lambda p: p <> ''), ' ') AS segmented
FROM w"""


COUNTED = LAB + f""",
cl AS (SELECT id, label, {pre_mt('comment')} AS processed_text,
              CAST('0x' || substr(md5('42:' || id), 1, 13) AS BIGINT) / pow(16, 13) AS u FROM lab),
cr AS (SELECT *, CASE WHEN u < 0.15 THEN 'test' WHEN u < 0.30 THEN 'val' ELSE 'train' END AS split FROM cl),
ct AS MATERIALIZED (SELECT label, split, unnest({tokens('processed_text')}) AS token FROM cr)"""


def counted(name, train, targets):
    """Multinomial naive Bayes, smoothing 1: ``name`` has (key, pred, confidence) for the rows (key, token, n) of ``targets``
    and the keys of ``targets`` + '_keys'."""
    return f"""{name}_tf AS MATERIALIZED (SELECT label, token, count(*) AS n FROM ct WHERE {train} GROUP BY ALL),
{name}_v AS MATERIALIZED (SELECT DISTINCT token FROM {name}_tf),
{name}_c AS MATERIALIZED (
  SELECT d.label, ln((d.n + 1) / (SELECT count(*) + (SELECT count(DISTINCT label) FROM cr WHERE {train}) FROM cr WHERE {train})) AS prior,
         ln(coalesce(t.n, 0) + (SELECT count(*) FROM {name}_v)) AS total
  FROM (SELECT label, count(*) AS n FROM cr WHERE {train} GROUP BY label) d
  LEFT JOIN (SELECT label, sum(n) AS n FROM {name}_tf GROUP BY label) t ON t.label = d.label),
{name}_s AS (
  SELECT x.key, c.label, sum(x.n * (ln(coalesce(tf.n, 0) + 1) - c.total)) AS s
  FROM {targets} x SEMI JOIN {name}_v v ON v.token = x.token CROSS JOIN {name}_c c
  LEFT JOIN {name}_tf tf ON tf.token = x.token AND tf.label = c.label GROUP BY ALL),
{name}_p AS (
  SELECT k.key, c.label, c.prior + coalesce(s.s, 0) AS s
  FROM {targets}_keys k CROSS JOIN {name}_c c LEFT JOIN {name}_s s ON s.key = k.key AND s.label = c.label),
{name} AS (
  SELECT key, arg_max(label, s) AS pred, 1 / sum(exp(s - m)) AS confidence
  FROM (SELECT *, max(s) OVER (PARTITION BY key) AS m FROM {name}_p) GROUP BY key)"""


COUNT_TEST = COUNTED + f""",
x_keys AS (SELECT id AS key FROM cr WHERE split = 'test'),
x AS (SELECT key, token, count(*) AS n FROM (
        SELECT id AS key, unnest({tokens('processed_text')}) AS token FROM cr WHERE split = 'test') GROUP BY ALL),
{counted('p', "split = 'train'", 'x')}"""

SQL["count_classifier"] = f"""
WITH {COUNT_TEST}
SELECT p.key AS id, cr.label, CAST(p.pred AS INTEGER) AS pred, round(p.confidence, 6) AS confidence FROM p JOIN cr ON cr.id = p.key"""

SQL["count_classifier_report"] = f"""
WITH {COUNT_TEST},
j AS (SELECT cr.label AS actual, p.pred AS predicted FROM p JOIN cr ON cr.id = p.key),
k AS (SELECT actual AS cls FROM j UNION SELECT predicted FROM j),
m AS (SELECT cls, (SELECT count(*) FROM j WHERE actual = cls) AS support, (SELECT count(*) FROM j WHERE predicted = cls) AS guessed,
             (SELECT count(*) FROM j WHERE actual = cls AND predicted = cls) AS tp FROM k),
n AS (SELECT *, CASE WHEN guessed = 0 THEN 0.0 ELSE tp / guessed END AS pr, CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS re FROM m)
SELECT 'sentiment' AS head, round(sum(tp) / sum(support), 6) AS accuracy, round(sum(pr * support) / sum(support), 6) AS precision,
       round(sum(re * support) / sum(support), 6) AS recall,
       round(sum(CASE WHEN pr + re = 0 THEN 0.0 ELSE 2 * pr * re / (pr + re) END * support) / sum(support), 6) AS f1,
       CAST(sum(support) AS BIGINT) AS support FROM n"""

SQL["score_text_stream"] = f"""
WITH {COUNTED},
x_keys AS (SELECT doc_id AS key FROM documents),
x AS MATERIALIZED (SELECT key, token, count(*) AS n FROM (
        SELECT doc_id AS key, unnest({tokens(pre_mt('text'))}) AS token FROM documents) GROUP BY ALL),
{counted('p1', "split = 'train'", 'x')},
{counted('p2', "split <> 'test'", 'x')}
SELECT key AS doc_id, CAST(pred AS INTEGER) AS pred, round(confidence, 6) AS confidence, 1 AS model_version FROM p1 WHERE key % 2 = 0
UNION ALL
SELECT key, CAST(pred AS INTEGER), round(confidence, 6), 2 FROM p2 WHERE key % 2 = 1"""

SQL["append_committed"] = f"WITH {LAB} SELECT id, label, task FROM lab"

SQL["resume_bucketed"] = SQL["resume_by_id"]

SQL["dictionary_rejects"] = """
WITH d AS (SELECT doc_id % 3 AS part, row_number() OVER (PARTITION BY doc_id % 3 ORDER BY doc_id) AS line_no, doc_id % 7 AS k,
                  CAST(doc_id AS VARCHAR) AS key, source FROM documents)
SELECT CAST(part AS INTEGER) AS part, line_no, CASE WHEN k > 2 THEN key END AS abbr, CASE WHEN k > 2 THEN source END AS "full",
       CASE k WHEN 0 THEN key WHEN 1 THEN key || ':' || source || ':' || source WHEN 2 THEN '' END AS line,
       CASE WHEN k = 1 THEN 'several colons' WHEN k < 3 THEN 'no colon' END AS reason
FROM d"""

SQL["comment_rejects"] = """
WITH d AS (SELECT doc_id, doc_id % 10 AS k, source FROM documents),
r AS (SELECT *, CASE WHEN k IN (2, 4, 5) THEN 'malformed' WHEN k = 1 THEN 'label' WHEN k = 3 THEN 'task' END AS reason FROM d)
SELECT doc_id AS id, CASE WHEN reason IS NULL THEN source || ', said "so"' END AS comment,
       CASE WHEN reason IS NULL THEN CAST(doc_id % 3 AS INTEGER) END AS label,
       CASE WHEN reason IS NULL THEN CAST(doc_id % 9 + 1 AS INTEGER) END AS task, reason
FROM r"""

SQL["json_dictionary"] = f"""
WITH t AS (SELECT doc_id, {clean('text')} AS t FROM documents),
d AS (SELECT lower(split_part(t, ' ', 1)) AS abbr, split_part(t, ' ', 2) AS f, doc_id FROM t)
SELECT abbr, arg_max(f, doc_id) AS "full" FROM d WHERE abbr <> '' AND f <> '' GROUP BY abbr"""

SQL["report_files"] = f"""
WITH r AS ({SQL["classification_report"]}), w AS ({SQL["weighted_metrics"]})
SELECT head, row, f1, support FROM r UNION ALL SELECT head, 'summary', f1, support FROM w"""

SQL["progress_append"] = f"WITH {LAB} SELECT id, CAST(label AS VARCHAR) AS label, CAST(task AS VARCHAR) AS task FROM lab"


def _sequences(x):
    """Longest sequences first; the texts of the tables hold none of their own."""
    for e, n in sorted(EMOJI_ROWS, key=lambda r: -len(r[0])):
        x = f"replace({x}, {q(e)}, {q(f':{n}:')})"
    return x


SQL["demojize_sequences"] = f"""
SELECT doc_id, {_sequences(f"""CASE doc_id % 5 WHEN 0 THEN text || {q(EMOJI_ROWS[0][0])} WHEN 1 THEN {q(EMOJI_ROWS[3][0])} || text
  WHEN 2 THEN {q(EMOJI_ROWS[4][0] + EMOJI_ROWS[1][0])} || text ELSE text END""")} AS text FROM documents"""
