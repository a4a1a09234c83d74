"""The same results as DuckDB SQL, one statement per query, built from shared CTEs."""

from __future__ import annotations

from .queries import EXACT_DEPTH, stop_list

# the languages of the given tables; the queries take theirs from the data
LANGUAGES = ["de", "en", "es", "fr"]
BLANK = r"\s\p{Z}\x85\x1C-\x1F"
URL = rf"https?://[^{BLANK}]+|www\.[^{BLANK}]+"
TAG = r"<[^\n]*?>"
PUNCTUATION = rf"[^\p{{L}}\p{{N}}_{BLANK}]+"
DIGITS = r"\p{Nd}+"


def sub(expr: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({expr}, '{pattern}', '{to}', 'g')"


def normalized(column: str) -> str:
    expr = f"strip_accents(lower(coalesce({column}, '')))"
    for pattern in (URL, TAG, PUNCTUATION, DIGITS):
        expr = sub(expr, pattern)
    return f"trim({sub(expr, f'[{BLANK}]+', ' ')})"


def stop_words() -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in stop_list()) + "]"


def tokens_of(column: str, keep: str = "length(x) >= 2 AND NOT list_contains(stop, x)") -> str:
    return f"list_filter(string_split({normalized(column)}, ' '), lambda x: {keep})".replace("stop,", f"{stop_words()},")


def number(expr: str, name: str, digits: int = 6) -> str:
    """Rounded, without negative zero."""
    return f"CASE WHEN round({expr}, {digits}) = 0 THEN 0.0 ELSE round({expr}, {digits}) END AS {name}"


SPLIT = "CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END"


def corpus(label: str = "lang", rated: bool = False) -> str:
    source = "documents JOIN labels USING (doc_id)" if rated else "documents"
    return f"corpus AS (SELECT doc_id, text, {label} AS label, source AS dataset, {SPLIT} AS split FROM {source})"


def tokenized(label: str = "lang", rated: bool = False) -> str:
    return corpus(label, rated) + f""",
docs AS MATERIALIZED (SELECT doc_id, label, dataset, split, {tokens_of('text')} AS tokens FROM corpus)"""


GRAMS = "list_concat(tokens, list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]))"


def counted(label: str = "lang", rated: bool = False) -> str:
    return tokenized(label, rated) + f""",
grams AS (SELECT doc_id, label, split, unnest({GRAMS}) AS term FROM docs),
terms AS MATERIALIZED (SELECT doc_id, label, split, term, count(*)::INTEGER AS tf FROM grams GROUP BY ALL)"""


def vocabulary(label: str = "lang", rated: bool = False, limit: int | None = 5000) -> str:
    top = f"ORDER BY cf DESC, term LIMIT {limit}" if limit else ""
    return counted(label, rated) + f""",
size AS (SELECT count(*) AS n FROM docs WHERE split = 'train'),
frequency AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM terms WHERE split = 'train' GROUP BY term),
kept AS (SELECT * FROM frequency WHERE df >= 2 AND df <= 0.95 * (SELECT n FROM size) {top}),
vocab AS MATERIALIZED (SELECT term, (row_number() OVER (ORDER BY term) - 1)::INTEGER AS idx, df, cf,
  ln((1 + (SELECT n FROM size)) / (1 + df)) + 1 AS idf FROM kept)"""


def weighted(label: str = "lang", rated: bool = False, limit: int | None = 5000) -> str:
    return vocabulary(label, rated, limit) + """,
raw AS (SELECT doc_id, label, split, idx, term, tf, (1 + ln(tf)) * idf AS r FROM terms JOIN vocab USING (term)),
feats AS MATERIALIZED (SELECT doc_id, label, split, idx, term, tf, r / sqrt(sum(r * r) OVER (PARTITION BY doc_id)) AS weight
  FROM raw)"""


def bayes(label: str = "lang", rated: bool = False) -> str:
    """Class sums over the dense class by term grid, and priors."""
    return weighted(label, rated) + """,
classes AS (SELECT label, count(*) AS n_docs FROM docs WHERE split = 'train' GROUP BY label),
seen AS (SELECT label, idx, sum(weight) AS w FROM feats WHERE split = 'train' GROUP BY ALL),
cells AS (SELECT c.label, v.idx, v.term, coalesce(s.w, 0) AS w
  FROM classes c CROSS JOIN vocab v LEFT JOIN seen s ON s.label = c.label AND s.idx = v.idx),
multinomial AS (SELECT label, idx, term,
  ln(w + 1.0) - ln(sum(w) OVER (PARTITION BY label) + 1.0 * count(*) OVER (PARTITION BY label)) AS logp FROM cells),
rest AS (SELECT label, idx, term, sum(w) OVER (PARTITION BY idx) + 1.0 - w AS r FROM cells),
complement AS (SELECT label, idx, term, -ln(r / sum(r) OVER (PARTITION BY label)) AS logp FROM rest)"""


def scored(label: str = "lang", rated: bool = False, model: str = "multinomial", prior: str | None = None, name="scored"):
    """Joint scores of the test documents, the arg-max label and the soft-max probabilities."""
    prior = prior or "ln(n_docs / (SELECT sum(n_docs) FROM classes))"
    return f"""
{name}_joint AS (SELECT d.doc_id, d.label, c.label AS class, {prior} + coalesce(s.s, 0) AS joint
  FROM docs d CROSS JOIN classes c LEFT JOIN (
    SELECT f.doc_id, m.label AS class, sum(f.weight * m.logp) AS s
    FROM feats f JOIN {model} m USING (idx) WHERE f.split = 'test' GROUP BY ALL) s ON s.doc_id = d.doc_id AND s.class = c.label
  WHERE d.split = 'test'),
{name}_proba AS MATERIALIZED (SELECT doc_id, label, class, joint,
  exp(joint - max(joint) OVER (PARTITION BY doc_id)) AS e FROM {name}_joint),
{name}_p AS (SELECT doc_id, label, class, e / sum(e) OVER (PARTITION BY doc_id) AS p FROM {name}_proba),
{name} AS MATERIALIZED (SELECT doc_id, any_value(label) AS label, arg_max(class, (joint, -rn)) AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY class) AS rn FROM {name}_proba) GROUP BY doc_id)"""


def metrics(source: str = "scored", by: str = "") -> str:
    """Per-class and summary metrics of a table with label and prediction."""
    g = f"{by}, " if by else ""
    on = f"USING ({g}label)"
    group = f"GROUP BY {by}" if by else ""
    return f"""
truth AS (SELECT {g}label, count(*) AS support, count(*) FILTER (label = prediction) AS tp FROM {source} GROUP BY ALL),
guess AS (SELECT {g}prediction AS label, count(*) AS predicted FROM {source} GROUP BY ALL),
per_class AS (SELECT {g}label, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp,
  CASE WHEN coalesce(predicted, 0) > 0 THEN coalesce(tp, 0) / predicted ELSE 0.0 END AS precision,
  CASE WHEN coalesce(support, 0) > 0 THEN tp / support ELSE 0.0 END AS recall,
  2 * coalesce(tp, 0) / (coalesce(support, 0) + coalesce(predicted, 0)) AS f1_score
  FROM truth FULL JOIN guess {on}),
summary AS (SELECT {g}sum(tp) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS precision,
  sum(recall * support) / sum(support) AS recall, sum(f1_score * support) / sum(support) AS f1_score
  FROM per_class {group})"""


def curves(source: str = "scored_p", only: str = "true", by: str = "") -> str:
    """Cumulative counts per class from the highest score down."""
    g = f"{by}, " if by else ""
    return f"""
tied AS (SELECT {g}class, round(p, 12) AS score, count(*) FILTER (label = class) AS pos, count(*) FILTER (label <> class) AS neg
  FROM {source} WHERE {only} GROUP BY ALL),
cum AS MATERIALIZED (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER a AS tp_total,
  sum(neg) OVER a AS fp_total, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
  row_number() OVER w AS rn
  FROM tied WINDOW w AS (PARTITION BY {g}class ORDER BY score DESC), a AS (PARTITION BY {g}class)),
auc AS (SELECT {g}class, 
  sum(CASE WHEN fp_total > 0 AND tp_total > 0 THEN neg * (2 * tp - pos) / 2.0 / (fp_total::DOUBLE * tp_total) END) AS area FROM cum GROUP BY ALL)"""


SECOND = "class = (SELECT max(label) FROM classes)"
RATED = ("quality", True)
SOURCE = ("source", False)


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts)


def folds(source: str) -> str:
    """Five folds: classes end to end in order of first appearance, dealt in turn."""
    return f"""
ranked AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY doc_id) AS r FROM {source}),
class_n AS (SELECT label, count(*) AS n, min(doc_id) AS f FROM {source} GROUP BY label),
starts AS (SELECT label, n, coalesce(sum(n) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
  FROM class_n),
dealt AS (SELECT label, i, count(*) FILTER ((s + j) % 5 = i) AS q
  FROM (SELECT label, s, unnest(range(n)) AS j FROM starts) CROSS JOIN range(5) t(i) GROUP BY ALL),
ends AS (SELECT label, i, sum(q) OVER (PARTITION BY label ORDER BY i) AS e FROM dealt),
folds AS MATERIALIZED (SELECT ranked.doc_id, ranked.label, min(i)::INTEGER AS fold
  FROM ranked JOIN ends ON ranked.label = ends.label AND ranked.r <= ends.e GROUP BY ranked.doc_id, ranked.label)"""


def _step(expr: str, table: str = "documents", key: str = "doc_id") -> str:
    return f"SELECT {key}, {expr} AS result FROM {table}"


def loading() -> dict[str, str]:
    c = with_(corpus())
    pivot = ", ".join(f"nullif(count(*) FILTER (label = '{x}'), 0) AS {x}" for x in LANGUAGES)
    return {
        "corpus_sizes": f"{c} SELECT split, count(*) AS n_rows, 4::BIGINT AS n_columns FROM corpus GROUP BY split",
        "corpus_label_counts": f"{c} SELECT split, label, count(*) AS n FROM corpus GROUP BY ALL",
        "corpus_dataset_counts": f"{c} SELECT split, dataset, count(*) AS n FROM corpus GROUP BY ALL",
        "dataset_label_crosstab": f"{c} SELECT dataset, {pivot} FROM corpus GROUP BY dataset",
        "missing_text_counts": f"{c} SELECT split, count(*) FILTER (text IS NULL) AS n_missing FROM corpus GROUP BY split",
        "texts_and_labels": f"{with_(corpus(*RATED))} SELECT doc_id, text, label FROM corpus",
        "csv_corpus_roundtrip": f"{c} SELECT doc_id, text, label, dataset, split, array_to_string({tokens_of('text')}, ' ') AS processed_text FROM corpus",
    }


def texts() -> dict[str, str]:
    words = f"words AS (SELECT DISTINCT unnest(regexp_extract_all({normalized('text')}, '[\\p{{L}}\\p{{N}}_]+')) AS word FROM benchmark)"
    spread = "SELECT doc_id, unnest(tokens) AS token, unnest(range(len(tokens))) AS pos FROM docs"
    gather = "coalesce(string_agg({w}, ' ' ORDER BY pos), '')"
    filtered = _step(
        "array_to_string(list_filter(regexp_extract_all(text, '[\\p{L}\\p{N}_]+'), "
        f"lambda x: NOT list_contains({stop_words()}, lower(x))), ' ')"
    )
    return {
        "lower_documents": _step("lower(coalesce(text, ''))"),
        "fold_documents": _step("strip_accents(lower(coalesce(text, '')))"),
        "remove_urls_pages": _step(sub("html", URL), "pages", "page_id"),
        "remove_tags_pages": _step(sub("html", TAG), "pages", "page_id"),
        "remove_punctuation_pages": _step(sub("html", PUNCTUATION), "pages", "page_id"),
        "remove_digits_pages": _step(sub("html", DIGITS), "pages", "page_id"),
        "collapse_blanks_documents": _step(f"trim({sub('text', f'[{BLANK}]+', ' ')})"),
        "normalize_documents": _step(normalized("text")),
        "normalize_pages": _step(normalized("html"), "pages", "page_id"),
        "normalize_conversations": f"SELECT conv_id, turn, {normalized('text')} AS result FROM conversations",
        "tokens": r"""WITH t AS (SELECT page_id, regexp_extract_all(html, '[\p{L}\p{N}_]+') AS ts FROM pages)
SELECT page_id, unnest(range(len(ts)))::INTEGER AS pos, unnest(ts) AS token FROM t""",
        "min_length_filter": _step(f"array_to_string({tokens_of('text', 'length(x) >= 4')}, ' ')"),
        "stopword_filter": filtered,
        "stopword_filter_by_code": filtered,
        "custom_stopword_antijoin": f"""{with_(tokenized(), words)}
SELECT d.doc_id, {gather.format(w='token')} AS result FROM docs d LEFT JOIN (
  SELECT * FROM ({spread}) WHERE token NOT IN (SELECT word FROM words WHERE length(word) <= 3)) t USING (doc_id)
GROUP BY d.doc_id""",
        "lemma_lookup": f"""{with_(tokenized(), words)}
SELECT d.doc_id, {gather.format(w='coalesce(lemma, token)')} AS result FROM docs d LEFT JOIN ({spread}) t USING (doc_id)
LEFT JOIN (SELECT word, word[:-4] AS lemma FROM words WHERE length(word) >= 5 AND word LIKE '%ing') l ON l.word = t.token
GROUP BY d.doc_id""",
        "processed_text": _step(f"array_to_string({tokens_of('text')}, ' ')"),
        "processed_samples": f"""SELECT doc_id, text, array_to_string({tokens_of('text')}, ' ') AS processed_text
FROM documents WHERE doc_id % 5 <> 0 ORDER BY doc_id LIMIT 3""",
    }


def features() -> dict[str, str]:
    v = with_(vocabulary())
    f = with_(weighted())
    three = "list_concat(" + GRAMS + ", list_transform(range(1, len(tokens) - 1), lambda i: tokens[i] || ' ' || tokens[i + 1] || ' ' || tokens[i + 2]))"
    return {
        "ngrams_up_to_three": f"""{with_(tokenized())} SELECT term, count(*) AS n
FROM (SELECT unnest({three}) AS term FROM docs) GROUP BY term""",
        "term_counts": f"{with_(counted())} SELECT doc_id, term, tf FROM terms",
        "raw_text_term_counts": r"""SELECT doc_id, term, count(*)::INTEGER AS tf
FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents) GROUP BY ALL""",
        "document_frequency": f"""{with_(counted())}, n AS (SELECT count(*) AS n FROM docs WHERE split = 'train')
SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM terms WHERE split = 'train' GROUP BY term
HAVING count(*) >= 0.002 * (SELECT n FROM n) AND count(*) <= 0.5 * (SELECT n FROM n)""",
        "vocabulary_topk": f"{v} SELECT term, idx, df, cf FROM vocab",
        "full_vocabulary": f"{with_(vocabulary(limit=None))} SELECT term, idx, df, cf FROM vocab",
        "idf": f"{v} SELECT idx, {number('idf', 'idf')} FROM vocab",
        "feature_names": f"{v} SELECT idx, term FROM vocab",
        "tfidf_weights": f"{f} SELECT doc_id, idx, {number('weight', 'weight')} FROM feats WHERE split = 'train'",
        "tfidf_transform_test": f"{f} SELECT doc_id, idx, term, {number('weight', 'weight')} FROM feats WHERE split = 'test'",
        "count_features": f"{f} SELECT doc_id, idx, tf::DOUBLE AS weight FROM feats WHERE split = 'test'",
        "both_features": f"{f} SELECT doc_id, idx, tf, {number('weight', 'weight')} FROM feats WHERE split = 'test'",
        "unbounded_tfidf": f"""{with_(weighted(limit=None))}
SELECT doc_id, idx, {number('weight', 'weight')} FROM feats WHERE split = 'test'""",
        "ml_vectors": f"""{with_(vocabulary(*RATED))} SELECT d.doc_id, d.label, count(v.idx)::INTEGER AS n_terms FROM docs d
LEFT JOIN terms t USING (doc_id) LEFT JOIN vocab v ON v.term = t.term WHERE d.split = 'train' GROUP BY ALL""",
        "ml_vector_entries": f"{with_(weighted(*RATED))} SELECT doc_id, label, idx, {number('weight', 'weight')} FROM feats",
        "feature_shapes": f"{v} SELECT split, count(*) AS n_docs, (SELECT count(*) FROM vocab) AS n_features FROM docs GROUP BY split",
    }


def exact_tree() -> str:
    """The tree of the rated documents, grown level by level from every value of every term."""

    def entropy(a: str, b: str) -> str:
        part = "CASE WHEN {x} > 0 THEN -({x}) / (({a}) + ({b}))::DOUBLE * log2(({x}) / (({a}) + ({b}))::DOUBLE) ELSE 0.0 END"
        return "(" + " + ".join(part.format(x=f"({x})", a=a, b=b) for x in (a, b)) + ")"

    parts = [weighted(*RATED), """
w AS MATERIALIZED (SELECT doc_id, split, idx, round(weight, 9) AS weight FROM feats WHERE round(weight, 9) > 0),
a0 AS MATERIALIZED (SELECT doc_id, label, 0::BIGINT AS node FROM docs WHERE split = 'train')"""]
    for i in range(EXACT_DEPTH + 1):
        parts.append(f"t{i} AS MATERIALIZED (SELECT node, count(*) FILTER (label = 0) AS t0, count(*) FILTER (label = 1) AS t1 FROM a{i} GROUP BY node)")
        if i == EXACT_DEPTH:
            break
        parts.append(f"""
o{i} AS MATERIALIZED (SELECT * FROM t{i} WHERE t0 + t1 >= 5 AND t0 > 0 AND t1 > 0),
h{i} AS MATERIALIZED (SELECT node, idx, weight, count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1
  FROM a{i} SEMI JOIN o{i} USING (node) JOIN w USING (doc_id) GROUP BY ALL),
z{i} AS (SELECT * FROM h{i} UNION ALL SELECT node, idx, 0.0, any_value(t0) - sum(n0)::BIGINT, any_value(t1) - sum(n1)::BIGINT FROM h{i} JOIN o{i} USING (node) GROUP BY node, idx),
c{i} AS (SELECT node, idx, weight, lead(weight) OVER v AS above, sum(n0) OVER v AS l0, sum(n1) OVER v AS l1 FROM z{i} WINDOW v AS (PARTITION BY node, idx ORDER BY weight)),
g{i} AS (SELECT node, idx, (weight + above) / 2 AS threshold, round({entropy('t0', 't1')}
    - (l0 + l1) / (t0 + t1)::DOUBLE * {entropy('l0', 'l1')} - (t0 + t1 - l0 - l1) / (t0 + t1)::DOUBLE * {entropy('t0 - l0', 't1 - l1')}, 10) AS gain
  FROM c{i} JOIN o{i} USING (node) WHERE above IS NOT NULL AND l0 + l1 >= 1 AND t0 + t1 - l0 - l1 >= 1),
b{i} AS MATERIALIZED (SELECT node, idx, threshold FROM g{i} QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, idx, threshold) = 1),
a{i + 1} AS MATERIALIZED (SELECT a.doc_id, a.label, 2 * a.node + CASE WHEN coalesce(w.weight, 0) <= b.threshold THEN 1 ELSE 2 END AS node
  FROM a{i} a JOIN b{i} b USING (node) LEFT JOIN w ON w.doc_id = a.doc_id AND w.idx = b.idx)""")
    nodes = " UNION ALL ".join(f"SELECT t.*, b.idx, b.threshold FROM t{i} t LEFT JOIN b{i} b USING (node)" for i in range(EXACT_DEPTH))
    parts.append(f"nodes AS MATERIALIZED ({nodes} UNION ALL SELECT *, NULL, NULL FROM t{EXACT_DEPTH})")
    parts.append(f"marked AS MATERIALIZED (SELECT *, t0 + t1 AS n, {entropy('t0', 't1')} AS impurity, (t1 > t0)::INTEGER AS prediction FROM nodes)")
    return with_(*parts).replace("WITH ", "WITH RECURSIVE ", 1)


def exact_trees() -> dict[str, str]:
    t = exact_tree()
    return {
        "exact_tree_nodes": f"""{t} SELECT node, CASE WHEN node > 0 THEN (node - 1) // 2 END AS parent,
  CASE WHEN node > 0 THEN CASE node % 2 WHEN 1 THEN 'left' ELSE 'right' END END AS side, {number('threshold', 'threshold')},
  {number('impurity', 'impurity')}, n, prediction, term FROM marked LEFT JOIN vocab USING (idx)""",
        "exact_tree_predict": f"""{t},
way AS (SELECT doc_id, 0::BIGINT AS node FROM docs WHERE split = 'test' UNION ALL
  SELECT y.doc_id, 2 * y.node + CASE WHEN coalesce(w.weight, 0) <= m.threshold THEN 1 ELSE 2 END
  FROM way y JOIN marked m ON m.node = y.node AND m.idx IS NOT NULL LEFT JOIN w ON w.doc_id = y.doc_id AND w.idx = m.idx)
SELECT d.doc_id, d.label, m.prediction, {number('m.t1 / m.n::DOUBLE', 'probability')}
FROM (SELECT doc_id, max(node) AS node FROM way GROUP BY doc_id) y JOIN marked m USING (node) JOIN docs d USING (doc_id)""",
        "exact_tree_importances": f"""{t},
below AS (SELECT (node - 1) // 2 AS node, sum(n * impurity) AS below FROM marked WHERE node > 0 GROUP BY ALL),
drops AS (SELECT idx, sum(n * impurity - below) AS drop FROM marked JOIN below USING (node) WHERE idx IS NOT NULL GROUP BY idx)
SELECT term, {number('CASE WHEN sum(drop) OVER () > 0 THEN drop / sum(drop) OVER () ELSE 0.0 END', 'importance')} FROM drops JOIN vocab USING (idx)""",
    }


def naive_bayes() -> dict[str, str]:
    uniform = "-ln((SELECT count(*) FROM classes))"
    grid = f"""
grid AS (SELECT a AS alpha, p AS fit_prior FROM (SELECT unnest([0.1, 0.5, 1.0, 1.5, 2.0]::DOUBLE[]) AS a) CROSS JOIN
  (SELECT unnest([true, false]) AS p)),
fold_class AS (SELECT t.fold, c.label, count(*) AS n FROM range(5) t(fold) JOIN folds c ON c.fold <> t.fold GROUP BY ALL),
seen_fold AS (SELECT fold, label, idx, sum(weight) AS w FROM feats JOIN folds USING (doc_id, label) GROUP BY ALL),
fold_sum AS (SELECT t.fold, s.label, s.idx, sum(w) AS w FROM range(5) t(fold) JOIN seen_fold s ON s.fold <> t.fold GROUP BY ALL),
dense AS (SELECT c.fold, c.label, v.idx, coalesce(w, 0) AS w FROM fold_class c CROSS JOIN vocab v
  LEFT JOIN fold_sum s ON s.fold = c.fold AND s.label = c.label AND s.idx = v.idx),
model AS (SELECT fold, label, idx, alpha,
  ln(w + alpha) - ln(sum(w) OVER g + alpha * count(*) OVER g) AS logp
  FROM dense CROSS JOIN (SELECT DISTINCT alpha FROM grid) WINDOW g AS (PARTITION BY fold, label, alpha)),
held AS (SELECT f.doc_id, d.fold, m.label AS class, alpha, sum(weight * logp) AS s
  FROM feats f JOIN folds d USING (doc_id) JOIN model m ON m.fold = d.fold AND m.idx = f.idx GROUP BY ALL),
joint AS (SELECT d.doc_id, d.label, d.fold, g.alpha, g.fit_prior, c.label AS class,
  coalesce(h.s, 0) + CASE WHEN fit_prior THEN ln(c.n / (SELECT sum(n) FROM fold_class x WHERE x.fold = d.fold))
    ELSE -ln((SELECT count(*) FROM fold_class x WHERE x.fold = d.fold)) END AS j
  FROM folds d JOIN fold_class c ON c.fold = d.fold CROSS JOIN grid g
  LEFT JOIN held h ON h.doc_id = d.doc_id AND h.class = c.label AND h.alpha = g.alpha),
guessed AS (SELECT alpha, fit_prior, fold, doc_id, any_value(label) AS label, arg_max(class, j) AS prediction
  FROM joint GROUP BY alpha, fit_prior, fold, doc_id)"""
    key = "alpha, fit_prior, fold"
    train = "train AS (SELECT doc_id, label FROM docs WHERE split = 'train')"
    search = with_(weighted(*RATED), train, folds("train"), grid, metrics("guessed", key))
    curve = f"""
steps AS (SELECT DISTINCT floor(x * (SELECT count(*) FROM folds WHERE fold <> 0))::BIGINT AS train_size
  FROM (SELECT unnest([0.1, 0.325, 0.55, 0.775, 1.0]::DOUBLE[]) AS x)),
part AS (SELECT t.fold, f.doc_id, f.label, row_number() OVER (PARTITION BY t.fold ORDER BY f.doc_id) AS r
  FROM range(5) t(fold) JOIN folds f ON f.fold <> t.fold),
used AS MATERIALIZED (SELECT train_size, fold, doc_id, label FROM part JOIN steps ON r <= train_size),
class_c AS (SELECT train_size, fold, label, count(*) AS n FROM used GROUP BY ALL),
sums AS (SELECT train_size, fold, u.label, idx, sum(weight) AS w FROM used u JOIN feats USING (doc_id) GROUP BY ALL),
dense AS (SELECT c.train_size, c.fold, c.label, v.idx, coalesce(w, 0) AS w FROM class_c c CROSS JOIN vocab v
  LEFT JOIN sums s ON s.train_size = c.train_size AND s.fold = c.fold AND s.label = c.label AND s.idx = v.idx),
model AS (SELECT train_size, fold, label, idx, ln(w + 1) - ln(sum(w) OVER g + count(*) OVER g) AS logp
  FROM dense WINDOW g AS (PARTITION BY train_size, fold, label)),
asked AS (SELECT train_size, fold, doc_id, label, 'train' AS part FROM used UNION ALL
  SELECT train_size, fold, doc_id, label, 'test' FROM folds CROSS JOIN steps),
hits AS (SELECT a.train_size, a.fold, a.doc_id, m.label AS class, sum(weight * logp) AS s
  FROM asked a JOIN feats f USING (doc_id) JOIN model m ON m.train_size = a.train_size AND m.fold = a.fold AND m.idx = f.idx
  GROUP BY ALL),
joint AS (SELECT a.*, c.label AS class, coalesce(h.s, 0) + ln(c.n / sum(c.n) OVER (PARTITION BY a.train_size, a.fold, a.doc_id)) AS j
  FROM asked a JOIN class_c c ON c.train_size = a.train_size AND c.fold = a.fold
  LEFT JOIN hits h ON h.train_size = a.train_size AND h.fold = a.fold AND h.doc_id = a.doc_id AND h.class = c.label),
guessed AS (SELECT train_size, fold, part, doc_id, any_value(label) AS label, arg_max(class, j) AS prediction
  FROM joint GROUP BY train_size, fold, part, doc_id)"""
    curved = with_(weighted(*RATED), train, folds("train"), curve, metrics("guessed", "train_size, fold, part")) + """,
curve AS (SELECT train_size, fold::INTEGER AS fold, max(f1_score) FILTER (part = 'train') AS train_f1,
  max(f1_score) FILTER (part = 'test') AS test_f1 FROM summary GROUP BY train_size, fold)"""
    stats = ", ".join(
        number(f"{fn}({c})", f"{c}_{n}") for c in ("train_f1", "test_f1") for n, fn in (("mean", "avg"), ("std", "stddev_pop"))
    )
    return {
        "nb_multinomial_model": f"{with_(bayes())} SELECT label, idx, term, {number('logp', 'logp')} FROM multinomial",
        "nb_complement_model": f"{with_(bayes())} SELECT label, idx, term, {number('logp', 'logp')} FROM complement",
        "nb_uniform_prior": f"{with_(bayes(*RATED), scored(*RATED, prior=uniform))} SELECT doc_id, label, prediction FROM scored",
        "nb_predict": f"{with_(bayes(*SOURCE), scored(*SOURCE))} SELECT doc_id, label, prediction FROM scored",
        "resumed_run": f"{with_(bayes(*SOURCE), scored(*SOURCE))} SELECT doc_id, label, prediction FROM scored",
        "nb_complement_predict": f"""{with_(bayes(*SOURCE), scored(*SOURCE, model='complement', prior='0.0'))}
SELECT doc_id, label, prediction FROM scored""",
        "nb_predict_proba": f"""{with_(bayes(*SOURCE), scored(*SOURCE))}
SELECT doc_id, class, {number('p', 'probability')} FROM scored_p""",
        "nb_grid_search": f"{search} SELECT alpha, fit_prior, fold::INTEGER AS fold, {number('f1_score', 'f1')} FROM summary",
        "nb_best_parameters": f"""{search} SELECT alpha, fit_prior, {number('avg(f1_score)', 'mean_f1')},
{number('stddev_pop(f1_score)', 'std_f1')} FROM summary GROUP BY alpha, fit_prior
ORDER BY round(avg(f1_score), 12) DESC, alpha, fit_prior DESC LIMIT 1""",
        "nb_holdout_report": f"""{search},
best AS (SELECT alpha, fit_prior, avg(f1_score) AS mean_f1, stddev_pop(f1_score) AS std_f1 FROM summary GROUP BY alpha, fit_prior
  ORDER BY round(avg(f1_score), 12) DESC, alpha, fit_prior DESC LIMIT 1),
train_class AS (SELECT label, count(*) AS n FROM train GROUP BY label),
train_sum AS (SELECT c.label, v.idx, coalesce(sum(f.weight), 0) AS w FROM train_class c CROSS JOIN vocab v
  LEFT JOIN (SELECT idx, label, weight FROM feats WHERE split = 'train') f ON f.idx = v.idx AND f.label = c.label GROUP BY ALL),
tuned AS (SELECT label, idx, ln(w + alpha) - ln(sum(w) OVER g + alpha * count(*) OVER g) AS logp
  FROM train_sum CROSS JOIN best WINDOW g AS (PARTITION BY label)),
test_sum AS (SELECT f.doc_id, m.label AS class, sum(f.weight * m.logp) AS s FROM feats f JOIN tuned m USING (idx)
  WHERE f.split = 'test' GROUP BY ALL),
test_joint AS (SELECT d.doc_id, d.label, c.label AS class, coalesce(s.s, 0) + CASE WHEN fit_prior
    THEN ln(c.n / (SELECT sum(n) FROM train_class)) ELSE -ln((SELECT count(*) FROM train_class)) END AS j
  FROM docs d CROSS JOIN train_class c CROSS JOIN best LEFT JOIN test_sum s ON s.doc_id = d.doc_id AND s.class = c.label
  WHERE d.split = 'test' AND d.label IS NOT NULL),
test_guess AS (SELECT doc_id, any_value(label) AS label, arg_max(class, j) AS prediction FROM test_joint GROUP BY doc_id),
report AS (WITH {metrics("test_guess")} SELECT * FROM summary)
SELECT alpha, fit_prior, {number('mean_f1', 'mean_f1')}, {number('std_f1', 'std_f1')}, {number('accuracy', 'held_out_accuracy')},
  {number('precision', 'held_out_precision')}, {number('recall', 'held_out_recall')}, {number('f1_score', 'held_out_f1_score')}
FROM best CROSS JOIN report""",
        "nb_learning_curve": f"""{curved} SELECT train_size, fold, {number('train_f1', 'train_f1')},
{number('test_f1', 'test_f1')} FROM curve""",
        "learning_curve_summary": f"{curved} SELECT 'Naive Bayes' AS model, train_size, {stats} FROM curve GROUP BY train_size",
    }


def selection() -> dict[str, str]:
    weights = f"""{with_(corpus())}, w AS (SELECT label, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS w
FROM corpus GROUP BY label)"""
    return {
        "balanced_class_weights": f"{weights} SELECT label, {number('w', 'class_weight')} FROM w",
        "class_weighted_documents": f"{weights} SELECT doc_id, label, {number('w', 'class_weight')} FROM corpus JOIN w USING (label)",
        "stratified_folds": f"{with_(corpus(), folds('corpus'))} SELECT doc_id, label, fold FROM folds",
        "random_split": f"""{with_(corpus())} SELECT doc_id, label,
CASE WHEN ('0x' || substr(md5('7:' || doc_id), 1, 8))::BIGINT % 10000 < 2500 THEN 'test' ELSE 'train' END AS split FROM corpus""",
        "stratified_sample": f"""{with_(corpus('source'))},
share AS (SELECT label, 777 * count(*) / sum(count(*)) OVER () AS x FROM corpus GROUP BY label),
quota AS (SELECT label, floor(x) + CASE WHEN row_number() OVER (ORDER BY floor(x) - x, label)
  <= 777 - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS q FROM share),
drawn AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id), doc_id) AS r FROM corpus)
SELECT doc_id, label FROM drawn JOIN quota USING (label) WHERE r <= q""",
    }


def evaluation() -> dict[str, str]:
    rated = with_(bayes(*RATED), scored(*RATED))
    source = with_(bayes(*SOURCE), scored(*SOURCE))
    lang = with_(bayes(), scored())
    second = f"{rated}, {curves(only=SECOND)}"
    names = ("precision", "recall", "f1_score")
    columns = ", ".join(number(c, c) for c in names)
    macro = ", ".join(number(f"avg({c})", c) for c in names)
    weighted_avg = ", ".join(number(f"sum({c} * support) / sum(support)", c) for c in names)
    dense = """labels AS (SELECT label FROM scored UNION SELECT prediction FROM scored),
matrix AS (SELECT a.label, b.label AS prediction, count(s.label) AS n FROM labels a CROSS JOIN labels b
  LEFT JOIN scored s ON s.label = a.label AND s.prediction = b.label GROUP BY ALL)"""
    wide = ", ".join(f"max(n) FILTER (prediction = '{x}') AS {x}" for x in LANGUAGES)
    rates = f"score AS threshold, fp / fp_total AS fpr, tp / tp_total AS tpr FROM cum"
    roc = "SELECT " + number("threshold", "threshold") + ", " + number("fpr", "fpr") + ", " + number("tpr", "tpr")
    points = "SELECT {c}score AS threshold, tp / (tp + fp) AS precision, CASE WHEN tp_total > 0 THEN tp / tp_total ELSE 1.0 END AS recall FROM cum UNION ALL SELECT {d}NULL, 1.0, 0.0"
    pr = number("threshold", "threshold") + ", " + number("precision", "precision") + ", " + number("recall", "recall")

    models = (
        ("Multinomial", "multinomial", None),
        ("Uniform prior", "multinomial", "-ln((SELECT count(*) FROM classes))"),
        ("Complement", "complement", "0.0"),
    )
    parts = [scored(*RATED, model=m, prior=p, name=f"s{i}") for i, (_, m, p) in enumerate(models)]
    every = " UNION ALL ".join(f"SELECT '{n}' AS model, label, prediction FROM s{i}" for i, (n, _, _) in enumerate(models))
    probs = " UNION ALL ".join(f"SELECT '{n}' AS model, label, class, p FROM s{i}_p" for i, (n, _, _) in enumerate(models))
    titles = {"accuracy": "Accuracy", "precision": "Precision", "recall": "Recall", "f1_score": "F1 Score", "area": "ROC AUC"}
    compared = ", ".join(number(c, f'"{t}"') for c, t in titles.items())
    comparison = f"""{with_(bayes(*RATED), *parts)}, scored AS ({every}), probs AS ({probs}), {metrics("scored", "model")},
{curves("probs", SECOND, "model")},
comparison AS (SELECT model AS "Model", {compared} FROM summary JOIN auc USING (model))"""
    unpivoted = """SELECT * FROM (UNPIVOT comparison ON "Accuracy", "Precision", "Recall", "F1 Score", "ROC AUC"
INTO NAME "Metric" VALUE "Score")"""
    return {
        "metrics_summary": f"{rated}, {metrics()} SELECT {number('accuracy', 'accuracy')}, {columns} FROM summary",
        "class_report": f"""{source}, {metrics()} SELECT label, {columns}, support FROM per_class UNION ALL
SELECT 'accuracy', NULL, NULL, {number('sum(tp) / sum(support)', 'f1_score')}, sum(support)::BIGINT FROM per_class UNION ALL
SELECT 'macro avg', {macro}, sum(support)::BIGINT FROM per_class UNION ALL
SELECT 'weighted avg', {weighted_avg}, sum(support)::BIGINT FROM per_class""",
        "confusion_matrix": f"{source}, {dense} SELECT label, prediction, n FROM matrix",
        "confusion_normalized": f"""{source}, {dense}, shares AS (SELECT label, prediction,
n / nullif(sum(n) OVER (PARTITION BY label), 0) AS share FROM matrix)
SELECT label, prediction, {number('share', 'share')} FROM shares""",
        "confusion_wide": f"{lang}, {dense} SELECT label, {wide} FROM matrix GROUP BY label",
        "roc_points": f"""{second}, points AS (SELECT {rates} WHERE rn = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT NULL, 0.0, 0.0) {roc} FROM points""",
        "roc_points_all": f"{second}, points AS (SELECT {rates} UNION ALL SELECT NULL, 0.0, 0.0) {roc} FROM points",
        "roc_auc": f"{second} SELECT {number('area', 'roc_auc')} FROM auc",
        "ovr_auc": f"{source}, {curves()} SELECT {number('CASE WHEN count(area) = count(*) THEN avg(area) END', 'roc_auc')} FROM auc",
        "ovr_auc_per_class": f"{source}, {curves()} SELECT class, {number('area', 'roc_auc')} FROM auc",
        "pr_points": f"{second}, points AS ({points.format(c='', d='')}) SELECT {pr} FROM points",
        "pr_points_multiclass": f"""{source}, {curves()},
points AS ({points.format(c='class, ', d='class, ')} FROM (SELECT DISTINCT class FROM cum)) SELECT class, {pr} FROM points""",
        "average_precision": f"""{source}, {curves()}, ap AS (SELECT class,
sum(CASE WHEN tp_total > 0 THEN pos / tp_total ELSE 0.0 END * (tp / (tp + fp))) AS x FROM cum GROUP BY class) SELECT class, {number('x', 'average_precision')} FROM ap""",
        "model_comparison": f"{comparison} SELECT * FROM comparison",
        "comparison_without_probability": f"""{comparison} SELECT * REPLACE (CASE WHEN "Model" = 'Multinomial' THEN "ROC AUC" END AS "ROC AUC")
FROM comparison WHERE "Model" <> 'Uniform prior'""",
        "timings_unpivot": f"""{comparison} SELECT "Model", "Metric", true AS measured FROM comparison
CROSS JOIN (VALUES ('Training Time (s)'), ('Prediction Time (s)')) AS t("Metric")""",
        "best_model": f'{comparison} SELECT "Model", "F1 Score" FROM comparison ORDER BY "F1 Score" DESC, "Model" LIMIT 1',
        "metrics_unpivot": f"{comparison} {unpivoted}",
        "metric_matrix": f"{comparison} SELECT * FROM comparison",
        "top_importances": f"""{with_(bayes())}, ranked AS (SELECT 'Naive Bayes' AS model, label AS class, term,
round(logp, 9) AS importance, row_number() OVER (PARTITION BY label ORDER BY abs(round(logp, 9)) DESC, term)::INTEGER AS rank
FROM multinomial) SELECT model, class, term, {number('importance', 'importance')}, rank FROM ranked WHERE rank <= 20""",
        "run_summary": f"""{with_(vocabulary())} SELECT count(*) FILTER (split = 'train') AS train_size,
count(*) FILTER (split = 'test') AS test_size, (SELECT count(*) FROM vocab) AS n_features,
count(DISTINCT label) FILTER (split = 'train') AS n_classes FROM docs""",
    }


def statistics() -> dict[str, str]:
    words = f"list_filter(regexp_split_to_array(text, '[{BLANK}]+'), lambda x: x <> '')"
    lengths = f"""{with_(corpus())}, lengths AS (SELECT split, len({words}) AS n_words FROM corpus)"""
    bins = f"""{lengths}, ranged AS (SELECT *, min(n_words) OVER (PARTITION BY split) AS lo, max(n_words) OVER (PARTITION BY split) AS hi
FROM lengths), binned AS (SELECT split, least(floor((n_words - lo) * 50 / (hi - lo)), 49)::INTEGER AS bin, lo, (hi - lo) / 50 AS width
FROM ranged), counted AS (SELECT split, bin, any_value(lo) AS lo, any_value(width) AS width, count(*) AS n_docs FROM binned GROUP BY ALL)"""
    density = f"""{lengths}, m AS (SELECT split, count(*) AS n, min(n_words) AS lo, max(n_words) AS hi,
  stddev_samp(n_words) * pow(count(*), -0.2) AS h FROM lengths GROUP BY split),
grid AS (SELECT m.*, point, lo + (hi - lo) * point / 199 AS x0 FROM m CROSS JOIN range(200) t(point)),
dens AS (SELECT split, point, any_value(x0) AS x, sum(exp(-0.5 * pow((x0 - n_words) / h, 2)) / (n * h * sqrt(2 * pi()))) AS d
  FROM grid JOIN lengths USING (split) GROUP BY split, point)"""
    tokens = f"{with_(tokenized())}, words AS (SELECT label, unnest(tokens) AS word FROM docs)"
    sums = """n AS (SELECT count(*) AS n FROM docs WHERE split = 'train'),
sums AS (SELECT term, sum(weight) AS s, sum(weight * weight) AS ss FROM feats WHERE split = 'train' GROUP BY term)"""
    feats = f"{with_(weighted())}, {sums}"
    variable = f"""{feats}, deviation AS (SELECT term, s, ss, sqrt(greatest(ss / (SELECT n FROM n) - pow(s / (SELECT n FROM n), 2), 0)) AS sd
FROM sums), top AS (SELECT * FROM deviation ORDER BY round(sd, 12) DESC, term LIMIT 20)"""
    correlated = f"""{variable}, chosen AS (SELECT doc_id, term, weight FROM feats WHERE split = 'train' AND term IN (SELECT term FROM top)),
products AS (SELECT a.term AS term_x, b.term AS term_y, sum(a.weight * b.weight) AS p FROM chosen a JOIN chosen b USING (doc_id) GROUP BY ALL),
corr AS (SELECT x.term AS term_x, y.term AS term_y, ((SELECT n FROM n) * coalesce(p, 0) - x.s * y.s)
  / (sqrt((SELECT n FROM n) * x.ss - x.s * x.s) * sqrt((SELECT n FROM n) * y.ss - y.s * y.s)) AS c
  FROM top x CROSS JOIN top y LEFT JOIN products ON term_x = x.term AND term_y = y.term)
SELECT term_x, term_y, {number('c', 'correlation')} FROM corr"""
    return {
        "label_distribution": f"""{with_(corpus())} SELECT label, count(*) FILTER (split = 'train') AS train_n,
count(*) FILTER (split = 'test') AS test_n FROM corpus GROUP BY label HAVING count(*) FILTER (split = 'train') > 0""",
        "doc_length_stats": f"""{lengths} SELECT split, {number('avg(n_words)', 'mean_words')}, median(n_words)::DOUBLE AS median_words,
max(n_words)::INTEGER AS max_words, min(n_words)::INTEGER AS min_words FROM lengths GROUP BY split""",
        "doc_length_histogram": f"""{bins} SELECT split, bin, {number('lo + bin * width', 'bin_from')},
{number('lo + (bin + 1) * width', 'bin_to')}, n_docs FROM counted""",
        "doc_length_density": f"{density} SELECT split, point::INTEGER AS point, {number('x', 'n_words')}, {number('round(d, 9)', 'density')} FROM dens",
        "word_frequency": f"{tokens} SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n DESC, word LIMIT 20",
        "word_counts": f"""SELECT word, count(*) AS n FROM (SELECT unnest({words}) AS word FROM documents)
WHERE NOT list_contains({stop_words()}, word) GROUP BY word""",
        "word_frequency_by_class": f"""{tokens}, counted AS (SELECT label, word, count(*) AS n FROM words GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, word)::INTEGER AS rank FROM counted)
SELECT * FROM ranked WHERE rank <= 10""",
        "feature_means": f"""{feats} SELECT term, {number('s / (SELECT n FROM n)', 'mean_weight')} FROM sums
ORDER BY round(s / (SELECT n FROM n), 12) DESC, term LIMIT 20""",
        "most_variable_features": f"{variable} SELECT term, {number('sd', 'std_weight')} FROM top",
        "feature_correlation": correlated,
        "feature_correlation_lower": correlated + " WHERE term_x > term_y",
    }


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for group in (loading, texts, features, naive_bayes, exact_trees, selection, evaluation, statistics):
        out.update(group())
    return out
