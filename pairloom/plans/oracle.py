"""The named queries as SQL over the given tables, for a check by another engine.

Written from the definitions, not from the Spark plans: a window where Spark
uses buckets or segments, a recursive walk where Spark folds an array.
"""

from __future__ import annotations

from pairloom.functions import text as T
from pairloom.operators.lemmas import LEAST as LEAST_VOTES, LONGEST
from pairloom.operators.wordvectors import LEAST, WINDOW
from pairloom.plans.derive import CLASSES, ENDINGS, EPOCH_STEPS, PIECES, RUN
from pairloom.plans.registry import STOP_WORDS


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_q(v) for v in values)


def _tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), {_q(T.TOKEN)})"


def _unit(key: str) -> str:
    return f"((CAST('0x' || substr(md5({key} || ':123'), 1, 13) AS BIGINT) + 1)::DOUBLE / 4503599627370497::DOUBLE)"


_CTES = {
    "pairs": """
        SELECT d.doc_id AS pair_id,
               nullif(trim(string_split(d.text, chr(10))[1]), '') AS question1,
               nullif(trim(CASE WHEN strpos(d.text, chr(10)) > 0 THEN substr(d.text, strpos(d.text, chr(10)) + 1) END), '') AS question2,
               l.quality AS is_duplicate
        FROM documents d JOIN labels l USING (doc_id)""",
    "complete": """
        SELECT * FROM pairs
        WHERE question1 IS NOT NULL AND question2 IS NOT NULL AND is_duplicate IS NOT NULL""",
    "weights": """
        SELECT is_duplicate, count(*) AS n,
               sum(count(*)) OVER () / (count(*) OVER () * count(*))::DOUBLE AS weight
        FROM complete GROUP BY is_duplicate""",
    "drawn": f"""
        SELECT c.*, row_number() OVER (
                   ORDER BY -ln({_unit('c.pair_id')}) / w.weight, c.pair_id) AS drawn_as,
               count(*) OVER () AS n
        FROM complete c JOIN weights w USING (is_duplicate)""",
    "split": """
        SELECT pair_id, question1, question2, is_duplicate,
               CASE WHEN drawn_as <= round_even(0.6::DOUBLE * n, 0) THEN 'train_split'
                    WHEN drawn_as <= round_even(0.6::DOUBLE * n, 0)
                         + round_even(0.5::DOUBLE * (n - round_even(0.6::DOUBLE * n, 0)), 0) THEN 'valid_split'
                    ELSE 'test_split' END AS split
        FROM drawn""",
    "marked": """
        SELECT pair_id, '[CLS] ' || substr(question1, 1, 150) || ' [SEP] ' || substr(question2, 1, 150)
               || ' [SEP] ' AS text, is_duplicate AS label
        FROM complete""",
    "doc_tokens": f"SELECT doc_id, {_tokens('text')} AS tokens FROM documents",
    "doc_words": """
        SELECT doc_id, i AS pos, tokens[i] AS token
        FROM (SELECT doc_id, tokens, unnest(range(1, len(tokens) + 1)) AS i FROM doc_tokens)""",
    "vocab": f"""
        SELECT token, (row_number() OVER (ORDER BY n DESC, token) + 103)::INTEGER AS id, n
        FROM (SELECT token, count(*) AS n FROM doc_words GROUP BY token)""",
    "lemmas": """
        SELECT f.token AS form, l.token AS lemma
        FROM vocab f JOIN vocab l ON f.token = l.token || 's'""",
    "lexicon": f"""
        SELECT f.token AS form, f.id,
               coalesce(arg_max(l.token, length(l.token)) FILTER (WHERE l.token IS NOT NULL), f.token) AS lemma
        FROM vocab f CROSS JOIN (SELECT unnest([{_list(ENDINGS)}]) AS ending)
        LEFT JOIN vocab l ON suffix(f.token, ending) AND l.token = left(f.token, length(f.token) - length(ending))
        GROUP BY f.token, f.id""",
    "rule_pairs": """
        SELECT form, length(form) - common AS strip, substr(lemma, common + 1) AS added
        FROM (SELECT form, lemma, len(list_filter(range(1, least(length(form), length(lemma)) + 1),
                  lambda i: left(form, i) = left(lemma, i))) AS common
              FROM lexicon WHERE id % 5 <> 0)""",
    "best_rules": f"""
        SELECT suffix, strip, added, n FROM (
            SELECT right(form, k) AS suffix, strip, added, count(*) AS n
            FROM (SELECT *, unnest(range(greatest(strip, 1), least(length(form), {LONGEST}) + 1)) AS k FROM rule_pairs)
            GROUP BY ALL)
        WHERE n >= {LEAST_VOTES}
        QUALIFY row_number() OVER (PARTITION BY suffix ORDER BY n DESC, strip, added DESC) = 1""",
    "lemma_rules": """
        SELECT b.* FROM best_rules b LEFT JOIN best_rules p ON p.suffix = right(b.suffix, length(b.suffix) - 1)
        WHERE p.suffix IS NULL OR p.strip <> b.strip OR p.added <> b.added""",
    "ruled": """
        SELECT form, lemma, coalesce(left(form, length(form) - strip) || added, form) AS guess
        FROM (SELECT l.form, l.lemma, r.strip, r.added
              FROM lexicon l LEFT JOIN lemma_rules r
                  ON r.suffix = right(l.form, length(r.suffix)) AND (r.strip < length(l.form) OR r.added <> '')
              WHERE l.id % 5 = 0
              QUALIFY row_number() OVER (PARTITION BY l.form ORDER BY length(r.suffix) DESC NULLS LAST) = 1)""",
    "all_lemmas": """
        SELECT form, lemma FROM lexicon WHERE id % 5 <> 0 UNION ALL SELECT form, guess FROM ruled""",
    "vectors": """
        SELECT v.token, e.vec_id AS row, e.embedding AS vector
        FROM vocab v JOIN embeddings e ON e.vec_id = v.id - 104""",
    "pieces": f"""
        SELECT token, id FROM vocab WHERE id < 104 + {PIECES}
        UNION ALL SELECT '##' || token, id + {PIECES} FROM vocab WHERE id < 104 + {PIECES}""",
    "marked_tokens": f"""
        SELECT pair_id, label, list_transform(regexp_extract_all(text, {_q(T.MARKED_TOKEN)}),
               lambda t: CASE WHEN t IN ('[CLS]', '[SEP]') THEN t ELSE lower(t) END) AS tokens
        FROM marked""",
    "marked_words": """
        SELECT pair_id, label, i AS pos, tokens[i] AS token
        FROM (SELECT pair_id, label, tokens, unnest(range(1, len(tokens) + 1)) AS i FROM marked_tokens)""",
    "ids": """
        SELECT pair_id, label, list(CASE token WHEN '[CLS]' THEN 101 WHEN '[SEP]' THEN 102
                   ELSE coalesce(id, 100) END ORDER BY pos) AS ids
        FROM marked_words LEFT JOIN vocab USING (token) GROUP BY pair_id, label""",
    "logits": f"""
        SELECT vec_id, label, list_transform(range(0, {CLASSES}), lambda k: list_sum(list_transform(
                   list_filter(embedding, lambda x, i: (i - 1) % {CLASSES} = k), lambda x: x::DOUBLE))) AS logits
        FROM embeddings""",
    "predicted": """
        SELECT vec_id, label, logits, (list_position(logits, list_max(logits)) - 1)::INTEGER AS prediction,
               list_max(logits)
               + ln(list_sum(list_transform(logits, lambda x: exp(x - list_max(logits)))))
               - logits[label + 1] AS loss
        FROM logits""",
    "train_log": f"""
        SELECT '{RUN}' AS run_id, event_id // {EPOCH_STEPS} AS epoch, event_id % {EPOCH_STEPS} + 1 AS step,
               event_id + 1 AS global_step, value AS loss,
               (event_type IN ('purchase', 'signup'))::INTEGER AS label, (value > 35)::INTEGER AS prediction
        FROM events""",
    "reports": """
        SELECT * FROM (
            SELECT run_id, epoch, step, step // 100 AS report_no, global_step,
                   avg(loss) OVER (PARTITION BY run_id ORDER BY global_step
                                   ROWS BETWEEN 99 PRECEDING AND 1 PRECEDING) AS step_loss
            FROM train_log)
        WHERE step % 100 = 0""",
    "epoch_losses": """
        SELECT run_id, epoch, n_steps,
               CASE WHEN n_steps > 1 THEN tail ELSE sum(total) OVER w / sum(n_steps) OVER w END AS train_loss
        FROM (SELECT run_id, epoch, count(*) AS n_steps, sum(loss) AS total,
                     avg(loss) FILTER (step > 1) AS tail
              FROM train_log GROUP BY run_id, epoch)
        WINDOW w AS (PARTITION BY run_id ORDER BY epoch ROWS UNBOUNDED PRECEDING)""",
    "windowed": """
        SELECT * FROM (
            SELECT *, coalesce(sum((step % 100 = 0)::BIGINT) OVER (PARTITION BY run_id ORDER BY global_step
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS window_no
            FROM train_log)
        QUALIFY max((step % 100 = 0)::INTEGER) OVER (PARTITION BY run_id, window_no) = 1""",
}


def _with(names: str, body: str, more: str = "", recursive: bool = False) -> str:
    """``body`` after the CTEs it names, in order of need."""
    ctes = ",\n".join(f"{n} AS ({_CTES[n]})" for n in names.split())
    ctes += (",\n" if ctes and more else "") + more
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"


# the greedy walk: at each place the longest piece of the vocabulary
def _walk(words: str) -> str:
    return f"""
        words AS ({words}),
        longest AS (SELECT max(length(token)) AS n FROM pieces),
        starts AS (
            SELECT word, unnest(range(1, length(word) + 1)) AS s FROM words),
        spans AS (
            SELECT word, s, unnest(range(s + 1, least(length(word) + 1, s + n) + 1)) AS e FROM starts, longest),
        best AS (
            SELECT word, s, max(e) AS e FROM spans
            JOIN pieces ON token = CASE WHEN s > 1 THEN '##' ELSE '' END || substr(word, s, e - s)
            GROUP BY word, s),
        walk AS (
            SELECT word, 1::BIGINT AS at, []::VARCHAR[] AS pieces FROM words
            UNION ALL
            SELECT w.word, b.e, list_append(w.pieces,
                       CASE WHEN b.s > 1 THEN '##' ELSE '' END || substr(b.word, b.s, b.e - b.s))
            FROM walk w JOIN best b ON b.word = w.word AND b.s = w.at),
        word_pieces AS (
            SELECT words.word, coalesce(any_value(walk.pieces), ['[UNK]']) AS pieces
            FROM words LEFT JOIN walk ON walk.word = words.word AND walk.at = length(words.word) + 1
            GROUP BY words.word)"""


def _metrics(cells: str, by: str = "", keys: str = "") -> str:
    """Class and overall metrics of a confusion table, optionally per group."""
    part = f"PARTITION BY {keys}" if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""
        cells AS ({cells}),
        sides AS (
            SELECT {by} class, sum(actual)::BIGINT AS actual, sum(predicted)::BIGINT AS predicted,
                   sum(hit)::BIGINT AS tp
            FROM (SELECT {by} label AS class, n AS actual, 0 AS predicted,
                         CASE WHEN label = prediction THEN n ELSE 0 END AS hit FROM cells
                  UNION ALL SELECT {by} prediction, 0, n, 0 FROM cells)
            GROUP BY {by} class),
        counts AS (
            SELECT {by} class, tp, predicted - tp AS fp, actual - tp AS fn,
                   (sum(actual) OVER ({part}) - actual - predicted + tp)::BIGINT AS tn FROM sides),
        by_class AS (
            SELECT *, (tp + tn) / nullif(tp + fp + fn + tn, 0)::DOUBLE AS acc,
                   tp / nullif(tp + fp, 0)::DOUBLE AS ppv, tp / nullif(tp + fn, 0)::DOUBLE AS tpr,
                   2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE AS f1,
                   (tp::DOUBLE * tn - fp::DOUBLE * fn)
                   / nullif(sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)), 0) AS mcc,
                   (tp / nullif(tp + fn, 0)::DOUBLE + tn / nullif(tn + fp, 0)::DOUBLE) / 2 AS auc
            FROM counts),
        overall AS (
            SELECT {by} sum(tp) / sum(tp + fn)::DOUBLE AS overall_acc,
                   CASE WHEN count(*) = count(f1) THEN avg(f1) END AS f1_macro,
                   sum(tp) / sum(tp + fn)::DOUBLE AS f1_micro,
                   (sum(tp)::DOUBLE * sum(tp + fn) - sum((tp + fn)::DOUBLE * (tp + fp)))
                   / nullif(sqrt((sum(tp + fn)::DOUBLE ^ 2 - sum((tp + fp)::DOUBLE ^ 2))
                                 * (sum(tp + fn)::DOUBLE ^ 2 - sum((tp + fn)::DOUBLE ^ 2))), 0) AS overall_mcc,
                   CASE WHEN count(*) = count(tpr) THEN avg(tpr) END AS tpr_macro,
                   sum(tp) / sum(tp + fn)::DOUBLE AS tpr_micro,
                   sum(tp) / sum(tp + fn)::DOUBLE AS ppv_micro,
                   CASE WHEN count(*) = count(ppv) THEN avg(ppv) END AS ppv_macro
            FROM by_class {group})"""


_PREDICTED_CELLS = "SELECT label, prediction, count(*) AS n FROM predicted GROUP BY label, prediction"
_LOG_NAMES = [
    ("Overall ACC", "overall_acc"), ("F1 Macro", "f1_macro"), ("F1 Micro", "f1_micro"),
    ("Overall MCC", "overall_mcc"), ("TPR Macro", "tpr_macro"), ("TPR Micro", "tpr_micro"),
    ("PPV Micro", "ppv_micro"), ("PPV Macro", "ppv_macro"),
]


def _long(split: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name} {split}' AS name, round({column}, 6) AS value FROM overall" for name, column in _LOG_NAMES
    )


def _doc_tokens(change: str) -> str:
    return _with(
        "doc_tokens",
        f"""SELECT doc_id, len(tokens)::BIGINT AS n_tokens, array_to_string(tokens, ' ') AS tokens
            FROM (SELECT doc_id, {change} AS tokens FROM doc_tokens)""",
    )


def _nulled(column: str) -> str:
    return f"CASE WHEN {column} NOT IN ({_list(T.MISSING_WORDS)}) THEN {column} END AS {column}"


def _replaced(text: str) -> str:
    blanked = f"translate({text}, {_q(T.PUNCTUATION)}, {_q(' ' * len(T.PUNCTUATION))})"
    for width in (4, 3, 2):
        blanked = f"replace({blanked}, {_q(' ' * width)}, ' ')"
    return f"regexp_replace({blanked}, {_q(T.STRIP)}, '', 'g')"


_PAIRS = "pairs complete weights drawn"
_VOCAB = "doc_tokens doc_words vocab"
_IDS = f"pairs complete marked marked_tokens marked_words {_VOCAB} ids"
_PADDED = "list_concat(ids[1:99], list_transform(range(0, 100 - least(len(ids), 99)), lambda x: 0))"
_SEGMENTS = """list_transform(range(1, len(ids) + 1),
    lambda i: CASE WHEN list_position(ids, 102) < i THEN 1 ELSE 0 END)"""
_CUT_SEGMENTS = """list_concat(segments[1:99],
    list_transform(range(0, 100 - least(len(segments), 99)), lambda x: 0))"""


def _regrouped(value: str, out: str, tables: str, keep: str = "TRUE") -> str:
    """One value per token of a document, joined in order; empty documents kept."""
    return _with(
        tables,
        f"""SELECT doc_id, coalesce(string_agg({value}, ' ' ORDER BY pos) FILTER ({keep}), '') AS {out}
            FROM doc_tokens LEFT JOIN looked_up USING (doc_id) GROUP BY doc_id""",
        "looked_up AS (SELECT w.*, t.* EXCLUDE (token) FROM doc_words w LEFT JOIN side t USING (token))",
    )


def _looked_up(side: str, value: str, out: str, tables: str, keep: str = "TRUE") -> str:
    return _regrouped(value, out, tables, keep).replace("looked_up AS", f"side AS ({side}),\nlooked_up AS", 1)


_RULES = f"{_VOCAB} lexicon rule_pairs best_rules lemma_rules"


def _kept_lemmas(dropped: str) -> str:
    """Lemmas of the tokens of each document but those like ``dropped``."""
    kept = f"list_filter(tokens, lambda t: NOT regexp_matches(t, {_q(dropped)}))"
    return _with(
        f"{_RULES} ruled all_lemmas",
        """SELECT d.doc_id, CASE WHEN d.tokens IS NOT NULL THEN coalesce(string_agg(m.lemma, ' ' ORDER BY p.pos), '') END AS lemmas
           FROM kept d LEFT JOIN placed p ON p.doc_id = d.doc_id LEFT JOIN all_lemmas m ON m.form = p.token
           GROUP BY d.doc_id, d.tokens""",
        f"""kept AS (SELECT doc_id, {kept} AS tokens FROM doc_tokens),
            placed AS (SELECT doc_id, i AS pos, tokens[i] AS token
                FROM (SELECT doc_id, tokens, unnest(range(1, len(tokens) + 1)) AS i FROM kept))""",
    )


_SHUFFLED = "row_number() OVER (ORDER BY md5({key} || ':123:0'), {key})"

ORACLE: dict[str, str] = {
    "scan_pairs": _with("pairs", f"SELECT {_nulled('question1')}, {_nulled('question2')}, is_duplicate FROM pairs"),
    "scan_indexed": f"""
        SELECT pair_id, {_nulled('question1')}, {_nulled('question2')}, is_duplicate
        FROM (SELECT a.conv_id * 100000 + a.turn AS pair_id, a.text AS question1, b.text AS question2,
                     0 AS is_duplicate
              FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)""",
    "scan_by_stem": """
        SELECT 'labels' AS stem, count(*) AS n_rows, count(doc_id) AS n_docs, NULL::BIGINT AS order_keys FROM labels
        UNION ALL SELECT 'lineitem', count(*), 0, sum(l_orderkey)::BIGINT FROM lineitem""",
    "write_splits": _with(f"{_PAIRS} split", "SELECT * FROM split"),
    "write_splits_sized": _with(f"{_PAIRS} split", "SELECT * FROM split"),
    "materialize_once": _with(
        f"{_PAIRS} split",
        """SELECT pair_id, '[CLS] ' || substr(question1, 1, 150) || ' [SEP] ' || substr(question2, 1, 150)
                  || ' [SEP] ' AS text, is_duplicate AS label, split FROM split""",
    ),
    "append_metrics": _with(
        "train_log reports epoch_losses windowed",
        f"""SELECT run_id, parent_run_id, epoch::INTEGER AS epoch, step, name, round(value, 6) AS value, run_type
            FROM (
                SELECT run_id, '{RUN}' AS parent_run_id, epoch, report_no AS step, name, value, 'train_child' AS run_type
                FROM (SELECT run_id, epoch, report_no, unnest(['step', 'train_step_loss', 'train_avg_loss']) AS name,
                             unnest([report_no::DOUBLE, step_loss, avg(step_loss) OVER (
                                 PARTITION BY run_id, epoch ORDER BY report_no ROWS UNBOUNDED PRECEDING)]) AS value
                      FROM reports)
                UNION ALL
                SELECT run_id, '{RUN}', epoch, report_no, name, value, 'train_child'
                FROM (SELECT run_id, window_no, epoch, step // 100 AS report_no FROM windowed WHERE step % 100 = 0)
                JOIN (SELECT run_id, window_no, unnest([{_list(f'{n} train' for n, _ in _LOG_NAMES)}]) AS name,
                             unnest([{', '.join(c for _, c in _LOG_NAMES)}]) AS value FROM overall)
                     USING (run_id, window_no)
                UNION ALL
                SELECT run_id, '{RUN}', epoch, NULL, unnest(['epoch', 'train_loss']),
                       unnest([(epoch + 1)::DOUBLE, train_loss]), 'train_child' FROM epoch_losses
                UNION ALL
                SELECT run_id, NULL, epoch, NULL, 'train_loss', train_loss, 'train_main' FROM epoch_losses)""",
        _metrics(
            "SELECT run_id, window_no, label, prediction, count(*) AS n FROM windowed GROUP BY ALL",
            "run_id, window_no,",
            "run_id, window_no",
        ),
    ),
    "drop_any_null": _with("pairs complete", "SELECT * FROM complete"),
    "null_tokens": _with(
        "pairs", f"SELECT pair_id, {_nulled('question1')}, {_nulled('question2')}, is_duplicate FROM pairs"
    ),
    "truncate_text": "SELECT doc_id, substr(text, 1, 150) AS text FROM documents",
    "marked_text": _with("pairs complete marked", "SELECT * FROM marked"),
    "label_project": _with(
        "pairs",
        "SELECT '[CLS] ' || question1 || ' [SEP] ' || question2 || ' [SEP] ' AS text, is_duplicate AS label FROM pairs",
    ),
    "lower_text": "SELECT doc_id, lower(text) AS text FROM documents",
    "cooccurrence": _with(
        "doc_tokens doc_words",
        """SELECT a, b, n, round(greatest(ln(CASE WHEN a = b THEN 2 * n ELSE n END * total / (l.m::DOUBLE * r.m)), 0), 6) AS ppmi
           FROM known JOIN sums l ON l.w = a JOIN sums r ON r.w = b CROSS JOIN (SELECT sum(m)::DOUBLE AS total FROM sums)""",
        f"""words AS (SELECT token AS w FROM doc_words GROUP BY token HAVING count(*) >= {LEAST}),
            near AS (SELECT l.token AS x, r.token AS y FROM doc_words l JOIN doc_words r
                ON l.doc_id = r.doc_id AND r.pos > l.pos AND r.pos <= l.pos + {WINDOW}),
            known AS (SELECT least(x, y) AS a, greatest(x, y) AS b, count(*) AS n FROM near
                WHERE x IN (SELECT w FROM words) AND y IN (SELECT w FROM words) GROUP BY ALL),
            sums AS (SELECT w, sum(n)::BIGINT AS m FROM (SELECT a AS w, n FROM known UNION ALL SELECT b, n FROM known) GROUP BY w)""",
    ),
    "drop_punct": _doc_tokens(
        f"list_filter(tokens, lambda t: NOT regexp_matches(t, {_q(T.PUNCT_OR_SPACE_TOKEN)}))"
    ),
    "drop_stop_words": _doc_tokens(f"list_filter(tokens, lambda t: t NOT IN ({_list(STOP_WORDS)}))"),
    "drop_numbers": _doc_tokens(f"list_filter(tokens, lambda t: NOT regexp_matches(t, {_q(T.DIGIT_TOKEN)}))"),
    "every_nth_step": _with(
        "train_log", "SELECT epoch, step, step // 100 AS report_no, loss FROM train_log WHERE step % 100 = 0"
    ),
    "remaining_rows": _with(
        _PAIRS, "SELECT pair_id, is_duplicate FROM drawn WHERE drawn_as > round_even(0.6::DOUBLE * n, 0)"
    ),
    "attach_weight": _with(
        "pairs complete weights",
        "SELECT pair_id, is_duplicate, round(weight, 6) AS weight FROM pairs LEFT JOIN weights USING (is_duplicate)",
    ),
    "token_ids": _with(_IDS, "SELECT pair_id, array_to_string(ids, ' ') AS ids FROM ids"),
    "vocab_row": _looked_up(
        "SELECT token, row FROM vectors", "coalesce(row::VARCHAR, '<null>')", "rows", f"{_VOCAB} vectors",
        "pos IS NOT NULL",
    ),
    "word_vectors": _with(
        f"{_VOCAB} vectors pairs complete",
        """SELECT pair_id, len(tokens)::BIGINT AS n_tokens,
                  coalesce(sum((token IS NOT NULL AND vector IS NULL)::BIGINT), 0)::BIGINT AS n_missing,
                  round(coalesce(sum(pos * coalesce(list_sum(list_transform(vector, lambda x, j: x::DOUBLE * j)), 0)), 0), 2) AS values_by_place
           FROM first LEFT JOIN placed USING (pair_id, tokens) LEFT JOIN vectors USING (token)
           GROUP BY pair_id, tokens""",
        f"""first AS (SELECT pair_id, {_tokens("question1 || ' ' || question2")} AS tokens FROM complete),
            placed AS (SELECT pair_id, tokens, i AS pos, tokens[i] AS token FROM (
                SELECT *, unnest(range(1, len(tokens) + 1)) AS i FROM first))""",
    ),
    "lemma_lookup": _looked_up(
        "SELECT form AS token, lemma FROM lemmas", "coalesce(lemma, token)", "lemmas", f"{_VOCAB} lemmas"
    ),
    "lemma_rules": _with(f"{_RULES}", "SELECT suffix, strip, added, n FROM lemma_rules"),
    "lemma_by_rule": _with(f"{_RULES} ruled", "SELECT form, guess AS lemma FROM ruled"),
    "lemma_accuracy": _with(
        f"{_RULES} ruled",
        """SELECT form <> lemma AS changed, count(*) AS n, count(*) FILTER (WHERE guess = lemma) AS "right"
           FROM ruled GROUP BY 1""",
    ),
    "drop_punct_lemmas": _kept_lemmas(T.PUNCT_OR_SPACE_TOKEN),
    "drop_numbers_lemmas": _kept_lemmas(T.DIGIT_TOKEN),
    "fix_oov": _looked_up(
        "SELECT token, TRUE AS known FROM vocab",
        f"CASE WHEN known THEN token ELSE {_replaced('token')} END",
        "fixed",
        _VOCAB,
        f"CASE WHEN known THEN token ELSE {_replaced('token')} END <> ''",
    ),
    "classes": _with("pairs complete", "SELECT DISTINCT is_duplicate FROM complete"),
    "class_weights": _with(
        "pairs complete weights", "SELECT is_duplicate, n, round(weight, 6) AS weight FROM weights"
    ),
    "confusion": _with("logits predicted", _PREDICTED_CELLS),
    "class_metrics": _with(
        "logits predicted",
        """SELECT class, tp, fp, fn, tn, round(acc, 6) AS acc, round(ppv, 6) AS ppv, round(tpr, 6) AS tpr,
                  round(f1, 6) AS f1, round(mcc, 6) AS mcc, round(auc, 6) AS auc,
                  CASE WHEN auc < 0.6 THEN 'Poor' WHEN auc < 0.7 THEN 'Fair' WHEN auc < 0.8 THEN 'Good'
                       WHEN auc < 0.9 THEN 'Very Good' WHEN auc IS NOT NULL THEN 'Excellent' END AS auc_grade
           FROM by_class""",
        _metrics(_PREDICTED_CELLS),
    ),
    "overall_metrics": _with(
        "logits predicted",
        "SELECT " + ", ".join(f"round({c}, 6) AS {c}" for _, c in _LOG_NAMES) + " FROM overall",
        _metrics(_PREDICTED_CELLS),
    ),
    "mean_loss_seeded": _with(
        "logits predicted",
        """SELECT count(*) AS n_batches, round(sum(loss) / (count(*) + 1), 6) AS seeded_loss,
                  round(avg(loss), 6) AS mean_loss
           FROM (SELECT batch_id, avg(loss) AS loss FROM placed GROUP BY batch_id)""",
        f"""placed AS (SELECT loss, ({_SHUFFLED.format(key='vec_id')} - 1) // 20 AS batch_id FROM predicted)""",
    ),
    "epoch_loss": _with(
        "train_log epoch_losses",
        "SELECT run_id, epoch, n_steps, round(train_loss, 6) AS train_loss FROM epoch_losses",
    ),
    "row_count": _with(
        "pairs complete",
        """SELECT count(*) AS n_rows, ceil(count(*) / 20)::BIGINT AS n_batches,
                  ceil(count(*) / 20)::BIGINT // 100 AS n_reports FROM complete""",
    ),
    "progress": "SELECT count(*) AS processed, count(*) // 100000 AS units FROM documents",
    "running_progress": "SELECT count(*) AS processed, count(*) // 100000 AS units FROM documents",
    "build_vocab": _with(_VOCAB, "SELECT token, id, n FROM vocab"),
    "step_loss": _with(
        "train_log reports",
        "SELECT run_id, epoch, step, report_no, round(step_loss, 6) AS step_loss FROM reports",
    ),
    "running_epoch_loss": _with(
        "train_log reports",
        """SELECT run_id, epoch, report_no, round(avg(step_loss) OVER (
               PARTITION BY run_id, epoch ORDER BY report_no ROWS UNBOUNDED PRECEDING), 6) AS avg_loss
           FROM reports""",
    ),
    "report_windows": _with(
        "train_log windowed",
        """SELECT run_id, window_no, sizes.n_rows, round(overall_acc, 6) AS overall_acc, round(f1_macro, 6) AS f1_macro,
                  round(overall_mcc, 6) AS overall_mcc, round(tpr_macro, 6) AS tpr_macro,
                  round(ppv_macro, 6) AS ppv_macro
           FROM overall JOIN sizes USING (run_id, window_no)""",
        _metrics(
            "SELECT run_id, window_no, label, prediction, count(*) AS n FROM windowed GROUP BY ALL",
            "run_id, window_no,",
            "run_id, window_no",
        )
        + ",\nsizes AS (SELECT run_id, window_no, count(*) AS n_rows FROM windowed GROUP BY run_id, window_no)",
    ),
    "batches": _with(
        "pairs complete",
        """SELECT batch_id, count(*) AS n, string_agg(pair_id::VARCHAR, ' ' ORDER BY place) AS pair_id,
                  string_agg(is_duplicate::VARCHAR, ' ' ORDER BY place) AS is_duplicate
           FROM placed GROUP BY batch_id""",
        f"""ordered AS (SELECT pair_id, is_duplicate, {_SHUFFLED.format(key='pair_id')} AS place FROM complete),
            placed AS (SELECT *, (place - 1) // 20 AS batch_id FROM ordered)""",
    ),
    "chunks": _with(
        "doc_tokens",
        """SELECT doc_id, ceil(len(tokens) / 100)::BIGINT AS n_chunks,
                  array_to_string(list_transform(range(0, ceil(len(tokens) / 100)::BIGINT),
                      lambda i: array_to_string(tokens[i * 100 + 1:i * 100 + 100], ' ')), '|') AS chunks
           FROM doc_tokens""",
    ),
    "weighted_sample": _with(
        _PAIRS, "SELECT pair_id, is_duplicate FROM drawn WHERE drawn_as <= round_even(0.6::DOUBLE * n, 0)"
    ),
    "weighted_split": _with(f"{_PAIRS} split", "SELECT pair_id, is_duplicate, split FROM split"),
    "stratified_split": _with(
        "pairs complete",
        """SELECT pair_id, is_duplicate, CASE WHEN place <= first THEN 'train_split'
               WHEN place <= first + round_even(0.5::DOUBLE * (n - first), 0) THEN 'valid_split' ELSE 'test_split' END AS split
           FROM (SELECT *, round_even(0.6::DOUBLE * n, 0) AS first FROM drawn)""",
        """drawn AS (SELECT pair_id, is_duplicate, count(*) OVER (PARTITION BY is_duplicate) AS n,
               row_number() OVER (PARTITION BY is_duplicate ORDER BY md5(pair_id || ':123'), pair_id) AS place FROM complete)""",
    ),
    "shuffle": f"SELECT doc_id, {_SHUFFLED.format(key='doc_id')} AS position FROM documents",
    "argmax": _with("logits predicted", "SELECT vec_id, label, prediction FROM predicted"),
    "replace_punct": f"SELECT doc_id, {_replaced('text')} AS text FROM documents",
    "tokenize": _doc_tokens("tokens"),
    "wordpiece": _with(
        f"{_VOCAB} pieces",
        "SELECT word, array_to_string(pieces, ' ') AS pieces FROM word_pieces",
        _walk("SELECT DISTINCT token AS word FROM doc_words"),
        recursive=True,
    ),
    "default_piece": _with(
        "pairs",
        f"""SELECT pair_id, CASE WHEN len(t1) = 0 THEN '<unk>' ELSE array_to_string(t1, ' ') END AS question1_pieces,
                   CASE WHEN len(t2) = 0 THEN '<unk>' ELSE array_to_string(t2, ' ') END AS question2_pieces
            FROM (SELECT pair_id, {_tokens("coalesce(question1, '')")} AS t1, {_tokens("coalesce(question2, '')")} AS t2
                  FROM pairs)""",
    ),
    "join_tokens": _with("doc_tokens", "SELECT doc_id, array_to_string(tokens, ' ') AS text FROM doc_tokens"),
    "clean_text": _looked_up(
        f"""SELECT token, base FROM (
                SELECT w.token, coalesce(l2.lemma, l1.lemma, w.once) AS base
                FROM (SELECT DISTINCT d.token, CASE WHEN v.token IS NOT NULL THEN d.token
                             ELSE {_replaced('d.token')} END AS once
                      FROM doc_words d LEFT JOIN vocab v USING (token)) w
                LEFT JOIN lemmas l1 ON l1.form = w.once LEFT JOIN lemmas l2 ON l2.form = l1.lemma)""",
        "base",
        "text",
        f"{_VOCAB} lemmas",
        f"base <> '' AND NOT regexp_matches(base, {_q(T.PUNCT_OR_SPACE_TOKEN)})",
    ),
    "segment_ids": _with(_IDS, f"SELECT pair_id, array_to_string({_SEGMENTS}, ' ') AS segments FROM ids"),
    "cut_and_pad": _with(
        _IDS,
        f"SELECT pair_id, len({_PADDED})::BIGINT AS n_ids, array_to_string({_PADDED}, ' ') AS ids FROM ids",
    ),
    "encode_sample": _with(
        _IDS,
        f"""SELECT pair_id, label, array_to_string({_PADDED}, ' ') AS ids,
                   array_to_string({_CUT_SEGMENTS}, ' ') AS segments
            FROM (SELECT *, {_SEGMENTS} AS segments FROM ids)""",
    ),
    "encode_sample_pieces": _with(
        f"pairs complete marked marked_tokens marked_words {_VOCAB} pieces",
        f"""SELECT pair_id, label, array_to_string({_PADDED}, ' ') AS ids,
                   array_to_string({_CUT_SEGMENTS}, ' ') AS segments
            FROM (SELECT *, {_SEGMENTS} AS segments FROM piece_ids)""",
        _walk("SELECT DISTINCT token AS word FROM marked_words WHERE token NOT IN ('[CLS]', '[SEP]')")
        + """,
        placed AS (
            SELECT pair_id, label, pos, unnest(range(1, len(p) + 1)) AS part, unnest(p) AS token
            FROM (SELECT m.*, coalesce(w.pieces, [m.token]) AS p
                  FROM marked_words m LEFT JOIN word_pieces w ON w.word = m.token)),
        piece_ids AS (
            SELECT pair_id, label, list(CASE token WHEN '[CLS]' THEN 101 WHEN '[SEP]' THEN 102
                       ELSE coalesce(id, 100) END ORDER BY pos, part) AS ids
            FROM placed LEFT JOIN pieces USING (token) GROUP BY pair_id, label)""",
        recursive=True,
    ),
    "cross_entropy": _with("logits predicted", "SELECT vec_id, round(loss, 6) AS loss FROM predicted"),
    "metrics_long": _with("logits predicted", _long("validation"), _metrics(_PREDICTED_CELLS)),
}
