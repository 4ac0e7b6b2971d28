"""The registered queries as SQL over the same tables, written independently of the jobs.

Only fixed values (word lists, limits, prompts, patterns) are shared with the package.
"""

from __future__ import annotations

from lingofold.functions.text import CAPTION_PROMPT
from lingofold.operators import segment as seg
from lingofold.operators.metrics import CHRF_PUNCTUATION

LABEL3 = "CASE lang WHEN 'en' THEN 'eng' WHEN 'fr' THEN 'fra' WHEN 'es' THEN 'spa' ELSE 'deu' END"
ISO_OF = "CASE {0} WHEN 'eng' THEN 'en' WHEN 'fra' THEN 'fr' WHEN 'spa' THEN 'es' WHEN 'deu' THEN 'de' ELSE {0} END"
BLANK = r"E' \t\n\r\f'"
TRUE_TOKENS = "__cmn__, __eng__, __fra__, __spa__"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(text: str) -> str:
    t = f"trim({text}, {BLANK})"
    return f"(CASE WHEN {t} = '' THEN [] ELSE regexp_split_to_array({t}, '[ \\t\\n\\r\\f]+') END)"


def plain_zero(x: str) -> str:
    return f"CASE WHEN {x} = 0 THEN 0.0::DOUBLE ELSE {x} END"


def n_words(text: str) -> str:
    return f"CAST(len({words(text)}) AS INTEGER)"


def by_source(pairs: list[tuple[str, str | None]], other: str) -> str:
    whens = " ".join(
        f"WHEN '{s}' THEN {'NULL' if v is None else quote(v)}" for s, v in pairs
    )
    return f"(CASE source {whens} ELSE {other} END)"


# Patterns of their own: only the list of abbreviations is shared with the segmenter.
BEFORE = r"(^|[^\p{N}\p{L}])"
STOPS, CLOSERS, OPENERS = "…?!.؟।۔", r"""\])»”’"'""", r"""(\["'«„“"""


def sentences(text: str, iso: str) -> str:
    hold, cut, keep = "chr(1)", "chr(2)", "chr(3)"
    pair, initial = BEFORE + r"(\p{L})[.]( ?)(\p{L})[.]", BEFORE + r"(\p{Lu})[.]"
    goes_on = rf"([.]+|[{STOPS}]+[{CLOSERS}]+)([ \t]+[{OPENERS}]*\p{{Ll}})"
    end = rf"([{STOPS}]+[{CLOSERS}]*)[ \t\n\r\f]+"
    held = f"regexp_replace({text}, {quote(pair)}, '\\1\\2' || {hold} || '\\3\\4' || {hold}, 'g')"
    whens = " ".join(
        f"WHEN '{code}' THEN regexp_replace({held}, {quote(BEFORE + '(' + '|'.join(names.split()) + ')[.]')}, "
        f"'\\1\\2' || {hold}, 'g')"
        for code, names in seg.ABBREVIATIONS.items()
    )
    held = f"(CASE {iso} {whens} ELSE {held} END)"
    held = f"regexp_replace({held}, {quote(initial)}, '\\1\\2' || {hold}, 'g')"
    held = f"regexp_replace({held}, {quote(goes_on)}, '\\1' || {keep} || '\\2', 'g')"
    marked = f"regexp_replace({held}, {quote(end)}, '\\1' || {cut}, 'g')"
    marked = f"regexp_replace({marked}, '([。？！]+[”』」]*)', '\\1' || {cut}, 'g')"
    pieces = (
        f"list_transform(string_split({marked}, {cut}), "
        f"lambda s: trim(replace(replace(s, {hold}, '.'), {keep}, ''), {BLANK}))"
    )
    whole = f"[trim({text}, {BLANK})]"
    return (
        f"list_filter(CASE WHEN {iso} IN ('th', 'km') THEN {whole} ELSE {pieces} END, "
        f"lambda s: s <> '')"
    )


def micro(x: str) -> str:
    return f"CAST(round(ln({x}) * 1000000) AS BIGINT)"


def trigrams(source: str, keys: str, text: str) -> str:
    """Query (keys, gram): trigrams of the words, each with a blank on either side."""
    pieces = f"regexp_extract_all(lower(replace({text}, chr(10), ' ')), '[^ \\t\\n\\r\\f]+')"
    return (
        f"SELECT {keys}, substr(w, i, 3) AS gram FROM (SELECT {keys}, w, unnest(range(1, length(w) - 1)) AS i "
        f"FROM (SELECT {keys}, ' ' || unnest({pieces}) || ' ' AS w FROM {source}))"
    )


MODEL = f"""
docs AS (SELECT *, {LABEL3} AS lang3, {LABEL3} || '_Latn' AS label FROM documents),
counts AS (SELECT label, gram, count(*) AS n
           FROM ({trigrams('docs', 'label', 'text')}) GROUP BY ALL),
labels_m AS (
  SELECT s.label, {micro('s.d::DOUBLE / a.d')} AS prior, t.total + v.v AS space,
         {micro('1::DOUBLE / (t.total + v.v)')} AS unseen
  FROM (SELECT label, count(*) AS d FROM docs GROUP BY label) s
  JOIN (SELECT label, sum(n)::BIGINT AS total FROM counts GROUP BY label) t USING (label),
       (SELECT count(*) AS d FROM docs) a, (SELECT count(DISTINCT gram) AS v FROM counts) v),
model AS (SELECT k.label, k.gram, {micro('(n + 1)::DOUBLE / space')} - unseen AS gain
          FROM counts k JOIN labels_m USING (label))"""


def ranking(name: str, source: str, key: str, text: str, scale: str) -> str:
    """CTEs ending in ``name(key, label, prob, pos)``; ``scale`` may use n_grams."""
    keys = ", ".join(f"g.{k.strip()}" for k in key.split(","))
    return f"""
{name}_k AS (SELECT {key}, {text} AS txt FROM {source}),
{name}_g AS (SELECT {key}, gram, count(*) AS c
             FROM ({trigrams(f'{name}_k', key, 'txt')}) GROUP BY ALL),
{name}_n AS (SELECT {key}, coalesce(sum(c), 0)::BIGINT AS n_grams
             FROM {name}_k LEFT JOIN {name}_g USING ({key}) GROUP BY {key}),
{name}_h AS (SELECT {keys}, m.label, sum(c * gain)::BIGINT AS gain
             FROM {name}_g g JOIN model m USING (gram) GROUP BY ALL),
{name}_s AS (SELECT {', '.join('n.' + k.strip() for k in key.split(','))}, n_grams, l.label,
                    prior + n_grams * unseen + coalesce(h.gain, 0) AS score
             FROM {name}_n n CROSS JOIN labels_m l
             LEFT JOIN {name}_h h ON h.label = l.label AND {' AND '.join(f'h.{k.strip()} = n.{k.strip()}' for k in key.split(','))}),
{name}_e AS (SELECT *, exp((score - max(score) OVER (PARTITION BY {key}))::DOUBLE / ({scale})) AS w
             FROM {name}_s),
{name} AS (SELECT {key}, label, w / sum(w) OVER (PARTITION BY {key}) AS prob,
                  row_number() OVER (PARTITION BY {key} ORDER BY score DESC, label) AS pos
           FROM {name}_e)"""


PLAIN = "1000000.0::DOUBLE"
PER_GRAM = "1000000.0::DOUBLE * greatest(n_grams, 1)"
GIVEN = by_source([("src0", "fra"), ("src1", "deu"), ("src2", "eng"), ("src3", "")], "NULL")


def top_of(name: str, key: str) -> str:
    return (
        f"SELECT {key}, split_part(label, '_', 1) AS lang, split_part(label, '_', 2) AS script, "
        f"prob FROM {name} WHERE pos = 1"
    )


ROUTED = f"""
asked AS (SELECT doc_id, text FROM docs WHERE coalesce({GIVEN}, '') = ''),
{ranking('dl', 'asked', 'doc_id', 'text', PER_GRAM)},
routed AS (
  SELECT d.doc_id, d.text, d.source, d.lang AS iso1,
         coalesce(t.lang, {GIVEN.replace('source', 'd.source')}) AS lang, t.script,
         CASE WHEN t.lang IS NULL THEN 1.0::DOUBLE ELSE t.prob END AS prob
  FROM docs d LEFT JOIN ({top_of('dl', 'doc_id')}) t USING (doc_id))"""

CORE = r"[^\p{L}\p{N}]"


def lexicon(name: str, pairs: str, rounds: int = 4, max_words: int | None = 32) -> str:
    """CTEs ending in ``name(src, tgt, token, translation, prob)`` of query ``pairs(src, source, target)``
    into English: rounds of expectation maximisation over the words of a sentence, which is cut into
    parts of ``max_words`` if given."""
    core = f"lower(regexp_replace(w, '^{CORE}+|{CORE}+$', '', 'g'))"

    def cores(text: str) -> str:
        return f"list_filter(list_transform({words(text)}, lambda w: {core}), lambda w: w <> '')"

    def cut(side: str) -> str:
        return f"{side}[part * len({side}) // parts + 1:(part + 1) * len({side}) // parts]"

    parts = f"ceil(greatest(len(s), len(t)) / {max_words})::BIGINT" if max_words else "1::BIGINT"
    ctes = [f"""{name}_p AS MATERIALIZED (
  SELECT row_number() OVER () AS id, src, weight, s, t, {parts} AS parts
  FROM (SELECT src, count(*) AS weight, {cores('source')} AS s, {cores('target')} AS t
        FROM ({pairs}) WHERE source IS NOT NULL AND target IS NOT NULL GROUP BY src, source, target)
  WHERE len(s) > 0 AND len(t) > 0),
{name}_c AS (SELECT id, src, weight, part, {cut('s')} AS s, {cut('t')} AS t
             FROM (SELECT *, unnest(range(parts)) AS part FROM {name}_p)),
{name}_l AS MATERIALIZED (
  SELECT id, part, place, src, weight, t[place] AS translation, len(s) AS n, unnest(s) AS token
  FROM (SELECT *, unnest(range(1, len(t) + 1)) AS place FROM {name}_c) WHERE len(s) > 0)"""]
    ctes.append(f"""{name}_n AS (
  SELECT *, n::DOUBLE * n / sum(n) OVER (PARTITION BY src, translation) AS strength FROM (
    SELECT src, token, translation, sum(weight / n::DOUBLE) AS e, sum(weight)::BIGINT AS n FROM {name}_l GROUP BY ALL
    HAVING sum(weight) >= 2)),
{name}_t0 AS MATERIALIZED (SELECT src, token, translation, p FROM (
  SELECT *, e / sum(e) OVER (PARTITION BY src, token) AS p, max(strength) OVER (PARTITION BY src, token) AS strongest
  FROM {name}_n) WHERE strength >= 0.1::DOUBLE * strongest AND round(p, 12) >= 0.001)""")
    for i in range(1, rounds):
        shares = (
            f"SELECT src, token, translation, weight * p / sum(p) OVER (PARTITION BY id, part, place) AS share "
            f"FROM {name}_l JOIN {name}_t{i - 1} USING (src, token, translation)"
        )
        ctes.append(f"""{name}_t{i} AS MATERIALIZED (SELECT * FROM (
  SELECT src, token, translation, e / sum(e) OVER (PARTITION BY src, token) AS p
  FROM (SELECT src, token, translation, sum(share) AS e FROM ({shares}) GROUP BY ALL)) WHERE round(p, 12) >= 0.001)""")
    ctes.append(f"""{name} AS MATERIALIZED (SELECT src, 'eng' AS tgt, token, translation, p AS prob FROM (
  SELECT *, row_number() OVER (PARTITION BY src, token ORDER BY round(p, 10) DESC, translation) AS n
  FROM {name}_t{rounds - 1}) WHERE n = 1)""")
    return ",\n".join(ctes)


def vowels_moved(text: str) -> str:
    found = words(f"translate(lower({text}), 'aeiou', 'eioua')")
    return f"array_to_string(list_concat({found}[2:], {found}[1:1]), ' ')"


SENTENCE_SIDES = f"""SELECT src, source, {vowels_moved('source')} AS target FROM (
    SELECT {LABEL3} AS src, unnest({sentences('text', 'lang')}) AS source FROM documents WHERE {LABEL3} <> 'eng')"""
LEXICON = lexicon("lexicon", SENTENCE_SIDES)
WHOLE_LEXICON = lexicon("lexicon", SENTENCE_SIDES, max_words=None)


def lexicon_sentences(name: str, source: str, keys: str, table: str = "lexicon") -> str:
    """CTE ``name(keys, translation)`` of ``source(keys, sentence, src, tgt)``."""
    core = f"lower(regexp_replace(raw, '^{CORE}+|{CORE}+$', '', 'g'))"
    word = (
        "CASE WHEN l.translation IS NULL THEN raw ELSE "
        f"regexp_extract(raw, '^{CORE}*') || l.translation || regexp_extract(raw, '{CORE}*$') END"
    )
    return f"""
{name}_t AS (SELECT {keys}, src, tgt, {words('sentence')} AS ws FROM {source}),
{name}_w AS (SELECT {keys}, src, tgt, i AS pos, ws[i] AS raw
             FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM {name}_t)),
{name} AS (SELECT {', '.join('w.' + k.strip() for k in keys.split(','))},
                  string_agg({word}, ' ' ORDER BY pos) AS translation
           FROM (SELECT *, {core} AS core FROM {name}_w) w
           LEFT JOIN {table} l ON l.src = w.src AND l.tgt = w.tgt AND l.token = w.core
           GROUP BY ALL)"""


PIECES = f"""
cut AS (SELECT doc_id, lang, {sentences('text', 'lang')} AS s FROM documents),
pieces AS (SELECT doc_id, lang, (i - 1)::INTEGER AS chunk_id, s[i] AS sentence
           FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM cut))"""

VOCABULARY = f"""
toks AS (SELECT doc_id, {words('lower(text)')} AS ws FROM documents),
tok AS (SELECT doc_id, i AS pos, ws[i] AS token
        FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM toks)),
vocab AS (SELECT token, 3 + row_number() OVER (ORDER BY count(*) DESC, md5(token), token) AS token_id
          FROM tok GROUP BY token),
ids AS (SELECT doc_id, pos, token_id FROM tok JOIN vocab USING (token)
        WHERE doc_id IN (SELECT doc_id FROM toks WHERE len(ws) <= 512))"""


def hashed(name: str, source: str, key: str, text: str, dims: int, mean: bool, norm: bool) -> str:
    """CTEs ending in ``name(key, dim, v)``: the non-zero places of hashed vectors as doubles."""
    scale = "/ any_value(nt)" if mean else ""
    value = "v / greatest(sqrt(sum(v * v) OVER (PARTITION BY k)), 1e-12)" if norm else "v"
    return f"""
{name}_t AS (SELECT {key} AS k, {words(f'lower({text})')} AS ws FROM {source}),
{name}_u AS (SELECT k, len(ws) AS nt, md5(unnest(ws)) AS h FROM {name}_t),
{name}_d AS (SELECT k, dim, sum(sgn)::DOUBLE {scale} AS v FROM (
    SELECT k, nt, ('0x' || substr(h, 1, 8))::BIGINT % {dims} AS dim,
           CASE WHEN substr(h, 9, 1) >= '8' THEN -1 ELSE 1 END AS sgn FROM {name}_u)
  GROUP BY k, dim HAVING sum(sgn) <> 0),
{name} AS (SELECT k, dim, ({value})::FLOAT::DOUBLE AS v FROM {name}_d)"""


def parts_of(name: str, table: str, key: str, prefix: str) -> str:
    """CTE ``name(k, id, t)``: the texts in runs of 511 words behind a prefix."""
    return f"""{name} AS (SELECT {key} || ':' || p AS k, {key} AS id,
  '{prefix}' || array_to_string(ws[p * 511 + 1:p * 511 + 511], ' ') AS t
  FROM (SELECT {key}, ws, unnest(range(greatest((len(ws) + 510) // 511, 1))) AS p
        FROM (SELECT {key}, {words('text')} AS ws FROM {table})))"""


def fingerprints(name: str, dims: int) -> str:
    return (
        f"SELECT k, {dims} AS n_dims, count(*)::INTEGER AS n_nonzero, "
        f"{plain_zero(f"round(sum(v * (dim + 1)) / {dims}, 5)")} AS ramp FROM {name} GROUP BY k"
    )


SIDES = """
one AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings),
shifted AS (SELECT id, v, list_concat(v[2:], v[1:1]) AS s FROM one),
blend AS (SELECT id, list_transform(v, lambda x, i: x * 0.3::DOUBLE + s[i]) AS b FROM shifted),
two AS (SELECT id, list_transform(b, lambda x: x / greatest(sqrt(list_dot_product(b, b)), 1e-12)) AS v
        FROM blend)"""


def nearest(name: str, queries: str, corpus: str, k: int) -> str:
    return f"""
{name}_s AS (SELECT q.id AS query_id, c.id, round(list_dot_product(q.v, c.v), 9) AS score
             FROM {queries} q, {corpus} c),
{name} AS (SELECT query_id, id, score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank
    FROM {name}_s) WHERE rank <= {k})"""


MARGINS = f"""{SIDES},
{nearest('fwd', 'one', 'two', 4)},
{nearest('bwd', 'two', 'one', 4)},
mass1 AS (SELECT query_id, sum(score) / 8 AS m FROM fwd GROUP BY query_id),
mass2 AS (SELECT query_id AS id, sum(score) / 8 AS m FROM bwd GROUP BY query_id),
cand AS (SELECT f.query_id, f.rank, f.id, f.score, f.score / (mass1.m + mass2.m) AS margin
         FROM fwd f JOIN mass1 USING (query_id) JOIN mass2 ON mass2.id = f.id),
best AS (SELECT query_id, id, margin FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(margin, 9) DESC, rank) AS p
    FROM cand) WHERE p = 1)"""


def vote(near: str) -> str:
    """CTE ``probs(query_id, label, prob)`` of ``near(query_id, label, score)``."""
    return f"""
dist AS (SELECT query_id, label, round(greatest(1 - score, 0), 9) AS d FROM {near}),
wts AS (SELECT query_id, label,
               CASE WHEN min(d) OVER (PARTITION BY query_id) = 0 THEN (d = 0)::INTEGER::DOUBLE
                    ELSE 1 / d END AS w FROM dist),
probs AS (SELECT query_id, label, sum(w) / sum(sum(w)) OVER (PARTITION BY query_id) AS prob
          FROM wts GROUP BY query_id, label)"""


FEW_SHOT = f"""
alls AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS e,
                row_number() OVER (PARTITION BY label ORDER BY vec_id) AS n FROM embeddings),
unit AS (SELECT id, label, n,
                list_transform(e, lambda x: x / greatest(sqrt(list_dot_product(e, e)), 1e-12)) AS v FROM alls),
train AS (SELECT * FROM unit WHERE n <= 20),
items AS (SELECT * FROM unit WHERE n > 20),
{nearest('nn', 'items', 'train', 10)},
near AS (SELECT nn.query_id, t.label, nn.score FROM nn JOIN train t USING (id)),
{vote('near')}"""


def chrf(pairs: str, keys: str, group: str, digits: int = 6) -> str:
    """Query (group, score) over CTE ``pairs(keys, group, hyp, ref)``."""
    punct = quote(CHRF_PUNCTUATION)
    split = (
        "CASE WHEN length(w) <= 1 THEN [w] "
        f"WHEN contains({punct}, right(w, 1)) THEN [left(w, length(w) - 1), right(w, 1)] "
        f"WHEN contains({punct}, left(w, 1)) THEN [left(w, 1), substr(w, 2)] ELSE [w] END"
    )
    chars = " UNION ALL ".join(
        f"SELECT {keys}, {group}, h, {n} AS o, unnest(list_transform(range(1, length(p) - {n} + 2), "
        f"lambda i: substr(p, i, {n}))) AS g FROM packed"
        for n in range(1, 7)
    )
    return f"""
sides AS (SELECT {keys}, {group}, true AS h, coalesce(hyp, '') AS t FROM {pairs}
          UNION ALL SELECT {keys}, {group}, false, coalesce(ref, '') FROM {pairs}),
packed AS (SELECT {keys}, {group}, h, regexp_replace(t, '[ \\t\\n\\r\\f]+', '', 'g') AS p,
                  flatten(list_transform({words('t')}, lambda w: {split})) AS ws FROM sides),
grams AS ({chars}
  UNION ALL SELECT {keys}, {group}, h, 7, unnest(ws) FROM packed
  UNION ALL SELECT {keys}, {group}, h, 8, unnest(list_transform(range(1, len(ws)),
            lambda i: ws[i] || ' ' || ws[i + 1])) FROM packed),
per AS (SELECT {keys}, {group}, o, g, count(*) FILTER (h) AS a, count(*) FILTER (NOT h) AS b
        FROM grams GROUP BY ALL),
seg AS (SELECT *, sum(b) OVER (PARTITION BY {keys}, {group}, o) AS held FROM per),
tot AS (SELECT {group}, o, sum(CASE WHEN held > 0 THEN a ELSE 0 END)::DOUBLE AS a, sum(b)::DOUBLE AS b,
               sum(least(a, b))::DOUBLE AS m FROM seg GROUP BY ALL),
pr AS (SELECT {group}, CASE WHEN a > 0 THEN m / a ELSE 1e-16 END AS p,
              CASE WHEN b > 0 THEN m / b ELSE 1e-16 END AS r FROM tot)
SELECT {group}, round(100 * (sum(CASE WHEN 4 * p + r > 0 THEN 5 * p * r / (4 * p + r) ELSE 1e-16 END)
       + (8 - count(*)) * 1e-16) / 8, {digits}) AS score FROM pr GROUP BY {group}"""


def report(rows: str) -> str:
    """Per-language report over CTE ``rows(truth, pred)``."""
    return f"""
SELECT lang, sum(is_true)::BIGINT AS n_true, sum(is_pred)::BIGINT AS n_pred, sum(hit)::BIGINT AS hits,
       round(sum(hit)::DOUBLE / nullif(sum(is_true), 0), 6) AS micro_f1,
       round(sum(hit)::DOUBLE / nullif(sum(is_pred), 0), 6) AS "precision",
       round(sum(hit)::DOUBLE / nullif(sum(is_true), 0), 6) AS recall,
       round(2.0::DOUBLE * sum(hit) / (sum(is_true) + sum(is_pred)), 6) AS f1
FROM (SELECT truth AS lang, 1 AS is_true, 0 AS is_pred, (truth = pred)::INTEGER AS hit FROM {rows}
      UNION ALL SELECT pred, 0, 1, 0 FROM {rows}) WHERE lang IS NOT NULL GROUP BY lang"""


PREFIXED = (
    "(CASE lang WHEN 'en' THEN 'query: ' WHEN 'fr' THEN 'passage: ' WHEN 'de' THEN 'Query: ' "
    "ELSE 'query:' END || text)"
)
GOOD_PREFIX = f"(starts_with({PREFIXED}, 'query: ') OR starts_with({PREFIXED}, 'passage: '))"
TOO_MANY = "'text has ' || {0} || ' tokens, the maximum is 512'"
RATED = """
rated AS (SELECT source, toxic, quality FROM documents JOIN labels USING (doc_id)),
scores AS (SELECT source AS lang, toxic = 1 AS use_src, avg(quality) AS score FROM rated GROUP BY ALL)"""
TRANSLATED = "unsupported {0} language ' || {1} || ', allowed: " + TRUE_TOKENS
MODELS = "known: multilingual_e5_large, siglip_text"


def golden(target: str, iso: str) -> str:
    return f"""WITH g AS (SELECT {sentences('text', iso)} AS p, {target} AS t FROM documents),
o AS (SELECT CASE WHEN len(p) <> len(t) THEN 'size' WHEN p <> t THEN 'text' ELSE 'exact' END AS o FROM g)
SELECT count(*) AS n, count(*) FILTER (o = 'size') AS n_size, count(*) FILTER (o = 'text') AS n_text,
       count(*) FILTER (o = 'exact') AS n_exact, round(avg((o = 'exact')::INTEGER), 6) AS fraction FROM o"""


def translated(name: str, source: str, threshold: float, table: str, refused: str) -> str:
    """CTEs ending in ``name(doc_id, t, message)`` of ``source(doc_id, text, given, tgt)``; ``refused``
    is the message for a sentence with languages ``src`` and ``tgt``, or null."""
    return f"""
{name}_asked AS (SELECT doc_id, text FROM {source} WHERE coalesce(given, '') = ''),
{ranking(f'{name}_dl', f'{name}_asked', 'doc_id', 'text', PER_GRAM)},
{name}_routed AS (
  SELECT d.doc_id, d.text, d.tgt, coalesce(t.lang, given) AS lang, CASE WHEN t.lang IS NULL THEN 1.0::DOUBLE ELSE t.prob END AS prob
  FROM {source} d LEFT JOIN ({top_of(f'{name}_dl', 'doc_id')}) t USING (doc_id)),
{name}_iso AS (SELECT *, {ISO_OF.format('lang')} AS iso1 FROM {name}_routed),
{name}_c AS (SELECT *, {sentences('text', 'iso1')} AS s FROM {name}_iso),
{name}_p AS (SELECT doc_id, tgt, lang, prob, (i - 1)::INTEGER AS chunk_id, s[i] AS sentence
             FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM {name}_c)),
{name}_low AS (SELECT doc_id, chunk_id, sentence FROM {name}_p WHERE prob < {threshold}),
{ranking(f'{name}_sl', f'{name}_low', 'doc_id, chunk_id', 'sentence', PER_GRAM)},
{name}_ready AS (SELECT p.doc_id, p.chunk_id, p.sentence, coalesce(t.lang, p.lang) AS src, p.tgt
  FROM {name}_p p LEFT JOIN ({top_of(f'{name}_sl', 'doc_id, chunk_id')}) t USING (doc_id, chunk_id)),
{name}_checked AS (SELECT *, {refused} AS message FROM {name}_ready),
{lexicon_sentences(f'{name}_done', f'(SELECT * FROM {name}_checked WHERE message IS NULL)', 'doc_id, chunk_id', table)},
{name} AS (SELECT c.doc_id, string_agg(translation, ' ' ORDER BY c.chunk_id) AS t,
             arg_min(message, c.chunk_id) FILTER (message IS NOT NULL) AS message
           FROM {name}_checked c LEFT JOIN {name}_done USING (doc_id, chunk_id) GROUP BY c.doc_id)"""


TURNS = "SELECT conv_id * 20 + turn AS idx, text FROM conversations"
TURN_SIDES = (
    "SELECT 'fra' AS src, replace(text, 'en', 'an') AS source, text AS target FROM turns "
    "UNION ALL SELECT 'cmn_Hant', replace(text, 'er', 'or'), text FROM turns"
)


def q8_run(name: str, given: str) -> str:
    """CTE ``name(lang, score)``: languages without a failed block."""
    refused = "CASE WHEN src NOT IN ('eng', 'fra', 'spa', 'deu', 'cmn_Hant') THEN 'no' END"
    return f"""
{name}_src AS (SELECT lang || ':' || batch || ':' || part AS doc_id, lang, batch, part, t AS text, {given} AS given, 'eng' AS tgt
               FROM blk WHERE lang <> 'eng'),
{translated(f'{name}_tr', f'{name}_src', 0.3, 'turn_lexicon', refused)},
{name}_bad AS (SELECT DISTINCT lang FROM {name}_src JOIN {name}_tr USING (doc_id) WHERE message IS NOT NULL),
{name}_pairs AS (SELECT s.batch, s.part, s.lang, coalesce(t.t, '') AS hyp, r.t AS ref
  FROM {name}_src s JOIN blk r ON r.lang = 'eng' AND r.batch = s.batch AND r.part = s.part
  LEFT JOIN {name}_tr t USING (doc_id) WHERE s.lang NOT IN (SELECT lang FROM {name}_bad)),
{name} AS (WITH {chrf(f"{name}_pairs", "batch, part", "lang", 12)})"""


#: Scripts in tie order, as the detector's labels name them.
SCRIPT_ORDER = [
    pair.split(":") for pair in (
        "Latn:Latin,Cyrl:Cyrillic,Arab:Arabic,Hans:Han,Hang:Hangul,Jpan:Hiragana Katakana,Deva:Devanagari,Grek:Greek,"
        "Hebr:Hebrew,Thai:Thai,Khmr:Khmer,Taml:Tamil,Sinh:Sinhala,Beng:Bengali,Armn:Armenian,Geor:Georgian,Gujr:Gujarati,"
        "Guru:Gurmukhi,Knda:Kannada,Laoo:Lao,Mlym:Malayalam,Mymr:Myanmar,Orya:Oriya,Telu:Telugu,Tibt:Tibetan,Ethi:Ethiopic,"
        "Tfng:Tifinagh,Olck:Ol_Chiki"
    ).split(",")
]
#: First letters of some of them, for the documents of each source.
SCRIPT_LETTERS = dict(zip(
    [f"src{i}" for i in range(12)],
    ["", "абвгд", "ابتثج", "的一是不了", "가나다라마", "あいうカキ", "अआइईउ", "αβγδε", "אבגדה", "กขคงจ", "აბგდე", "ԱԲԳԴԵ"], strict=True,
))
SCRIPT_TEXT = "(CASE source " + " ".join(
    f"WHEN '{source}' THEN translate(text, 'aeiorntshlud', '{(letters * 3)[:12]}')" for source, letters in SCRIPT_LETTERS.items() if letters
) + " ELSE text END)"


def image_rows(stage: str) -> str:
    """Query (vec_id, n_dims, n_nonzero, ramp, error_stage) of the images drawn from the vectors."""
    return f"""WITH e AS (SELECT vec_id, embedding, {stage} AS error_stage FROM embeddings),
px AS (SELECT vec_id, i, floor(greatest(least(embedding[i + 1]::DOUBLE, 1), -1) * 127 + 128)::INTEGER AS p
  FROM (SELECT vec_id, embedding, unnest(range(64)) AS i FROM e WHERE error_stage IS NULL)),
ch AS (SELECT vec_id, i // 8 AS y, i % 8 AS x, unnest([0, 1, 2]) AS c, unnest([p, 255 - p, p // 2]) AS p FROM px),
grid AS (SELECT vec_id, c * 384 + r * 24 + g AS dim, (p / 127.5::DOUBLE - 1)::FLOAT::DOUBLE AS v
  FROM ch JOIN (SELECT unnest(range(16)) AS r) ON r * 8 // 16 = y JOIN (SELECT unnest(range(24)) AS g) ON g * 8 // 24 = x),
f AS (SELECT vec_id, count(*)::INTEGER AS n_dims, count(*) FILTER (v <> 0)::INTEGER AS n_nonzero,
        {plain_zero('round(sum(v * (dim + 1)) / count(*), 5)')} AS ramp FROM grid GROUP BY vec_id)
SELECT e.vec_id, n_dims, n_nonzero, ramp, error_stage FROM e LEFT JOIN f USING (vec_id)"""


Q1_SOURCE = (
    "CASE WHEN source = 'src9' THEN 'missing text' WHEN source = 'src5' THEN "
    "'unknown model unknown, known: nllb, seamlessm4t_text2text' END"
)

ORACLE_SQL = {
    "s1_read_requests": "SELECT lang, md5(text) AS text_md5 FROM documents",
    "s3_class_map": "SELECT 'p' || p_partkey AS label, p_name || ' ' || p_type AS description FROM part",
    "s4_parallel_wide": f"""SELECT doc_id AS id, l.l AS lang, 'Latn' AS script,
  md5(CASE WHEN {LABEL3} = l.l THEN text ELSE '' END) AS sentence_md5
  FROM documents, (SELECT unnest(['eng', 'fra', 'spa', 'deu']) AS l) l""",
    "s5_aligned_pairs": """WITH p AS (SELECT a.conv_id * 1000 + a.turn AS idx, a.text AS s1, b.text AS s2
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)
SELECT 1 AS side, idx, md5(s1) AS text_md5 FROM p UNION ALL SELECT 2, idx, md5(s2) FROM p""",
    "s6_golden_segments": """WITH g AS (SELECT lang, doc_id, text, string_split(replace(text, '. ', '.' || chr(2)), chr(2)) AS t
  FROM documents)
SELECT lang, doc_id::VARCHAR AS title, md5(text) AS text_md5, len(t)::INTEGER AS n_target,
  md5(array_to_string(t, chr(2))) AS target_md5 FROM g""",
    "s7_write_results": f"""SELECT doc_id, CASE WHEN {n_words('text')} > 512 THEN 'error' ELSE 'ok' END AS status
  FROM documents""",
    "p1_with_options": """WITH e AS (SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events)
SELECT event_id, CASE WHEN k < 25 THEN 7 ELSE k END AS k, 0.5::DOUBLE AS threshold,
       CASE WHEN k >= 20 AND k < 25 THEN 'INVALID_ARG' END AS error_code FROM e""",
    "p2_decode_text": """SELECT doc_id, CASE WHEN source <> 'src3' THEN md5(text) END AS text_md5,
  CASE WHEN source = 'src3' THEN 'INVALID_ARG' END AS error_code FROM documents""",
    "p3_decode_image_bytes": """SELECT doc_id,
  CASE WHEN source <> 'src5' THEN md5(text) WHEN lang <> 'en' THEN md5('!!!') END AS content_md5,
  CASE WHEN source = 'src5' AND lang = 'en' THEN 'INVALID_ARG' END AS error_code FROM documents""",
    "p4_flatten_newlines": "SELECT doc_id, md5(replace(text, chr(10), ' ')) AS text_md5 FROM documents",
    "p5_split_label": f"""SELECT doc_id, CASE WHEN source <> 'src7' THEN {LABEL3} END AS lang,
  CASE WHEN source <> 'src7' THEN 'Latn' END AS script,
  CASE WHEN source = 'src7' THEN 'INVALID_ARG' END AS error_code FROM documents""",
    "p6_to_iso1": f"""WITH c AS (SELECT doc_id, {by_source([
        ('src0', 'ary'), ('src1', 'prs'), ('src2', 'yue'), ('src3', 'zlm'), ('src4', 'xxx'),
        ('src5', 'fr'), ('src6', 'srp'), ('src7', 'nob')], LABEL3)} AS code FROM documents)
SELECT doc_id, code, CASE code WHEN 'ary' THEN 'ar' WHEN 'prs' THEN 'fa' WHEN 'yue' THEN 'zh'
  WHEN 'zlm' THEN 'ms' WHEN 'srp' THEN 'sh' WHEN 'nob' THEN 'no' ELSE {ISO_OF.format('code')} END AS iso1 FROM c""",
    "p7_fix_chinese": f"""SELECT doc_id, {by_source([('src0', 'cmn_Hant'), ('src1', 'cmn'),
        ('src2', 'cmn'), ('src3', 'yue')], LABEL3)} AS lang FROM documents""",
    "p8_default_target": """SELECT doc_id,
  CASE WHEN source = 'src1' THEN NULL WHEN lang = 'fr' THEN 'fra'
       WHEN source IN ('src0', 'src2') THEN 'eng_Latn' ELSE 'eng' END AS tgt,
  CASE WHEN source = 'src1' THEN 'INVALID_ARG' END AS error_code FROM documents""",
    "p9_lang_token": f"SELECT doc_id, '__' || {LABEL3} || '__' AS token FROM documents",
    "p10_prompt": """SELECT p_partkey, 'query: ' || p_name AS query, 'A photo of a ' || p_name || '.' AS caption,
  'This is a photo from ImageNet''s ' || p_type || ' category. This category contains photos of '
  || p_name || '.' AS category FROM part""",
    "p11_label_from_path": "SELECT doc_id, source AS label FROM documents",
    "p12_corpus_code": f"""SELECT doc_id, {by_source([('src0', 'zho_Hant'), ('src1', 'zho_Hans')], LABEL3)} AS code
  FROM documents""",
    "p13_dominant_script": f"""WITH t AS (SELECT doc_id, {SCRIPT_TEXT} AS t FROM documents),
c AS (SELECT doc_id, unnest([{', '.join(
    "{'n': len(regexp_extract_all(t, '[" + "".join(chr(92) + "p{" + n + "}" for n in names.split()) + "]')), 'r': "
    + str(r) + ", 's': '" + code + "'}" for r, (code, names) in enumerate(SCRIPT_ORDER))}]) AS e FROM t)
SELECT doc_id, CASE WHEN max(e.n) > 0 THEN arg_max(e.s, e.n * 100 - e.r) END AS script FROM c GROUP BY doc_id""",
    "v1_require": """SELECT doc_id, CASE WHEN source IN ('src1', 'src2') THEN 'INVALID_ARG' END AS error_code,
  CASE source WHEN 'src1' THEN 'missing text' WHEN 'src2' THEN 'missing lang' END AS message FROM documents""",
    "v2_require_model": f"""SELECT doc_id, CASE WHEN source = 'src1' THEN 'unknown model word2vec, {MODELS}' END
  AS message FROM documents""",
    "v3_require_language": f"""SELECT doc_id, CASE WHEN lang = 'de' THEN '{TRANSLATED.format('source', "'deu'")}'
  WHEN source = 'src1' THEN '{TRANSLATED.format('target', "'tlh'")}' END AS message FROM documents""",
    "v4_max_tokens": f"""WITH w AS (SELECT doc_id, {n_words('text')} AS n_tokens FROM documents)
SELECT doc_id, n_tokens, CASE WHEN n_tokens > 512 THEN {TOO_MANY.format('n_tokens')} END AS message FROM w""",
    "v5_require_prefix": """SELECT doc_id, CASE WHEN lang NOT IN ('en', 'fr') THEN 'INVALID_ARG' END AS error_code
  FROM documents""",
    "v6_first_error": f"""SELECT doc_id, CASE WHEN source = 'src1' THEN 'input'
  WHEN {n_words(PREFIXED)} > 512 THEN 'tokens' WHEN NOT {GOOD_PREFIX} THEN 'prefix' ELSE 'ok' END AS stage
  FROM documents""",
    "v7_isolate_batch": """SELECT doc_id, CASE WHEN length(text) % 7 <> 0 THEN length(text) END AS size,
  CASE WHEN length(text) % 7 = 0 THEN 'INTERNAL' END AS error_code,
  CASE WHEN length(text) % 7 = 0 THEN 'ValueError in model' END AS message FROM documents""",
    "d1_explode_sentences": f"WITH {PIECES} SELECT doc_id, chunk_id, md5(sentence) AS sentence_md5 FROM pieces",
    "d2_route_by_source": f"""WITH {MODEL}, {ROUTED}
SELECT doc_id, lang, script, round(prob, 6) AS prob FROM routed""",
    "d3_redetect_low_confidence": f"""WITH {MODEL}, {ROUTED},
rows_c AS (SELECT *, {sentences('text', 'iso1')} AS s FROM routed),
rows_p AS (SELECT doc_id, lang, prob, (i - 1)::INTEGER AS chunk_id, s[i] AS sentence
           FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM rows_c)),
low AS (SELECT doc_id, chunk_id, sentence FROM rows_p WHERE prob < 0.95),
{ranking('sl', 'low', 'doc_id, chunk_id', 'sentence', PLAIN)}
SELECT p.doc_id, p.chunk_id, coalesce(t.lang, p.lang) AS lang, t.lang IS NOT NULL AS redetected
FROM rows_p p LEFT JOIN ({top_of('sl', 'doc_id, chunk_id')}) t USING (doc_id, chunk_id)""",
    "d4_reassemble": """WITH c AS (SELECT conv_id, turn, text, length(text) % 11 = 0 AS bad FROM conversations)
SELECT conv_id, CASE WHEN NOT bool_or(bad) THEN md5(string_agg(text, ' ' ORDER BY turn)) END AS text_md5,
  'turn ' || min(turn) FILTER (bad) AS message FROM c GROUP BY conv_id""",
    "d5_align_by_key": """SELECT d.doc_id, quality, toxic, CASE WHEN l.doc_id IS NULL THEN 'no result' END AS message
  FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "d6_dispatch": f"""SELECT doc_id, CASE WHEN lang = 'en' THEN 'words' ELSE 'chars' END AS model,
  CASE WHEN lang = 'en' THEN {n_words('text')} ELSE length(text)::INTEGER END AS n FROM documents""",
    "d7_cross_corpus": f"""WITH {SIDES}, {nearest('nn', 'two', 'one', 1)}
SELECT query_id, id, round(score, 6) AS score FROM nn""",
    "m1_train_lid": f"""WITH {MODEL}, grams AS (SELECT DISTINCT gram FROM counts)
SELECT g.gram, l.label, l.unseen + coalesce(m.gain, 0) AS logp
FROM grams g CROSS JOIN labels_m l LEFT JOIN model m ON m.gram = g.gram AND m.label = l.label""",
    "m2_detect_language": f"""WITH {MODEL}, {ranking('r', 'docs', 'doc_id', 'text', PLAIN)}
SELECT doc_id, lang, script, round(prob, 6) AS prob FROM ({top_of('r', 'doc_id')})""",
    "m3_detect_top_k": f"""WITH {MODEL}, {ranking('r', 'docs', 'doc_id', 'text', PER_GRAM)}
SELECT doc_id, (pos - 1)::INTEGER AS rank, split_part(label, '_', 1) AS lang,
       split_part(label, '_', 2) AS script, round(prob, 6) AS prob FROM r WHERE pos <= 3 AND prob >= 0.02""",
    "m4_segment": f"""SELECT doc_id, len(s)::INTEGER AS n_sentences, md5(array_to_string(s, chr(2))) AS sentences_md5
  FROM (SELECT doc_id, {sentences('text', 'lang')} AS s FROM documents)""",
    "m4_sentence_ends": rf"""WITH w AS (SELECT lang, {words('text')} AS ws FROM documents WHERE lang IS NOT NULL),
o AS (SELECT lang, regexp_replace(ws[i], '^[^\p{{L}}\p{{N}}]+|["''»”’)\],;:!?…]+$', '', 'g') AS bare, coalesce(ws[i + 1], '') AS nxt
      FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM w)),
t AS (SELECT lang, lower(regexp_replace(bare, '[.]$', '')) AS word, ends_with(bare, '.') AS dot,
             regexp_matches(nxt, '^["''«„“(\[]*\p{{Ll}}') AS low FROM o),
c AS (SELECT lang, word, count(*) FILTER (dot) AS k, count(*) FILTER (NOT dot) AS m, count(*) FILTER (dot AND low) AS n_low
      FROM t WHERE regexp_matches(word, '^\p{{L}}[\p{{L}}.''’-]*$') GROUP BY lang, word),
p AS (SELECT *, (sum(k) OVER l)::DOUBLE / (sum(k + m) OVER l) AS p, length(replace(word, '.', '')) AS size FROM c
      WINDOW l AS (PARTITION BY lang)),
s AS (SELECT *, 2 * ((k * ln(0.99::DOUBLE) + m * ln(1 - 0.99::DOUBLE)) - (k * ln(p) + m * ln(greatest(1 - p, 1e-12::DOUBLE))))
        * exp(-size) * (length(word) - size + 1) * pow(size::DOUBLE, -m) AS score FROM p WHERE k > 0)
SELECT lang, word, k AS n_dot, m AS n_plain, n_low AS n_lower, {plain_zero('round(score, 6)')} AS score,
  score >= 0.3 OR (n_low >= 3 AND n_low >= 0.5 * k AND k >= m) AS is_abbreviation FROM s""",
    "m5_train_lexicon": f"""WITH {WHOLE_LEXICON}
SELECT src, tgt, token, translation, round(prob, 6) AS prob FROM lexicon""",
    "m5_translate_sentences": f"""WITH {PIECES}, {WHOLE_LEXICON},
jobs AS (SELECT doc_id, chunk_id, sentence, {LABEL3} AS src, 'eng' AS tgt FROM pieces),
{lexicon_sentences('done', 'jobs', 'doc_id, chunk_id')}
SELECT doc_id, chunk_id, md5(translation) AS translation_md5 FROM done""",
    "m6_tokenize_pad": f"""WITH {VOCABULARY},
lists AS (SELECT doc_id, list(token_id ORDER BY pos) AS l FROM ids GROUP BY doc_id),
padded AS (SELECT doc_id, list_concat(l, list_transform(range(512 - len(l)), lambda i: 1)) AS l FROM lists)
SELECT t.doc_id, len(ws)::INTEGER AS n_tokens, CASE WHEN len(ws) <= 512 THEN 512 END AS n_ids,
  CASE WHEN len(ws) <= 512 THEN md5(array_to_string(p.l, ' ')) END AS ids_md5,
  CASE WHEN len(ws) > 512 THEN 'INVALID_ARG' END AS error_code FROM toks t LEFT JOIN padded p USING (doc_id)""",
    "m7_attention_mask": f"""WITH t AS (SELECT doc_id, {n_words('text')} AS n FROM documents)
SELECT doc_id, CASE WHEN n <= 512 THEN 512 END AS n_mask, CASE WHEN n <= 512 THEN n END AS n_on FROM t""",
    "m8_masked_mean": f"""WITH {VOCABULARY},
picked AS (SELECT doc_id, token_id % (SELECT count(*) FROM embeddings) AS vec_id, count(*) AS c FROM ids GROUP BY ALL),
flat AS (SELECT vec_id, unnest(range(64)) AS dim, unnest(embedding) AS x FROM embeddings)
SELECT doc_id, dim::INTEGER AS dim, {plain_zero('round(sum(c * x::DOUBLE) / sum(c), 6)')} AS value
FROM picked JOIN flat USING (vec_id) GROUP BY doc_id, dim""",
    "m8_masked_mean_all": f"""WITH {VOCABULARY},
picked AS (SELECT doc_id, token_id % (SELECT count(*) FROM embeddings) AS vec_id, count(*) AS c FROM ids GROUP BY ALL),
flat AS (SELECT vec_id, unnest(range(64)) AS dim, unnest(embedding) AS x FROM embeddings),
means AS (SELECT doc_id, dim::INTEGER AS dim, {plain_zero('round(sum(c * x::DOUBLE) / sum(c), 6)')} AS value
  FROM picked JOIN flat USING (vec_id) GROUP BY doc_id, dim)
SELECT t.doc_id, dim, value, CASE WHEN dim IS NULL THEN 'INVALID_ARG' END AS error_code
FROM toks t LEFT JOIN means USING (doc_id)""",
    "m9_l2_normalize": f"""WITH t AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x * 3) AS e
  FROM embeddings),
u AS (SELECT vec_id, unnest(range(64))::INTEGER AS dim,
  unnest(list_transform(e, lambda x: x / sqrt(list_dot_product(e, e)))) AS x FROM t)
SELECT vec_id, dim, {plain_zero('round(x, 6)')} AS value FROM u""",
    "m10_embed_default": f"""WITH t AS (SELECT doc_id, source, CASE WHEN source = 'src1' THEN '' ELSE 'query: ' END || text AS t
  FROM documents),
c AS (SELECT doc_id, t, CASE WHEN {n_words('t')} > 512 THEN 'tokens' WHEN NOT (starts_with(t, 'query: ')
  OR starts_with(t, 'passage: ')) THEN 'prefix' END AS error_stage FROM t),
ok AS (SELECT * FROM c WHERE error_stage IS NULL),
{hashed('h', 'ok', 'doc_id', 't', 1024, True, True)}
SELECT c.doc_id, n_dims, n_nonzero, ramp, error_stage FROM c LEFT JOIN ({fingerprints('h', 1024)}) f ON f.k = c.doc_id""",
    "m11_embed_caption": f"""WITH c AS (SELECT doc_id, text, CASE WHEN {n_words('text')} > 64 THEN 'tokens' END AS error_stage
  FROM documents),
ok AS (SELECT * FROM c WHERE error_stage IS NULL),
{hashed('h', 'ok', 'doc_id', 'text', 1152, False, False)}
SELECT c.doc_id, n_dims, n_nonzero, ramp, error_stage FROM c LEFT JOIN ({fingerprints('h', 1152)}) f ON f.k = c.doc_id""",
    "m12_embed_image": image_rows("CASE WHEN vec_id % 10 = 3 THEN 'image' END"),
    "q3_embed_image": image_rows(
        "CASE vec_id % 10 WHEN 3 THEN 'image' WHEN 5 THEN 'base64' WHEN 8 THEN 'model' END"),
    "m13_predict_batches": """SELECT doc_id, len(regexp_extract_all(text, '[aeiou]')) AS n_vowels,
  CAST(NULL AS VARCHAR) AS error_code FROM documents""",
    "k1_similarity": f"""WITH {SIDES}
SELECT a.id, round(list_dot_product(a.v, b.v), 6) AS ip,
  round(list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 6) AS cosine,
  round(greatest(1 - list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 0), 6)
  AS distance FROM one a JOIN two b USING (id)""",
    "k2_knn": f"""WITH {SIDES}, {nearest('nn', 'one', 'two', 4)}
SELECT query_id, rank, id, round(score, 6) AS score FROM nn""",
    "k4_neighbour_mass": f"""WITH {SIDES}, {nearest('nn', 'one', 'two', 4)}
SELECT query_id, round(sum(score) / 8, 6) AS mass FROM nn GROUP BY query_id""",
    "k5_margin_score": f"WITH {MARGINS} SELECT query_id, rank, id, round(margin, 6) AS margin FROM cand",
    "k6_rerank_top1": f"WITH {MARGINS} SELECT query_id, id, round(margin, 6) AS margin FROM best",
    "k7_knn_classify": f"WITH {FEW_SHOT} SELECT query_id, label, round(prob, 6) AS prob FROM probs",
    "k8_zero_shot": f"""WITH classes AS (SELECT DISTINCT replace(p_name, ' ', '_') AS label, p_name FROM part),
cls AS (SELECT label, ('0x' || substr(md5(label), 1, 15))::BIGINT AS id,
        {quote(CAPTION_PROMPT).replace('{text}', "' || p_name || '")} AS t FROM classes),
itm AS (SELECT p_partkey, 'A photo of a ' || lower(p_type) || ' ' || p_name || ' .' AS t FROM part),
{hashed('hc', 'cls', 'id', 't', 1152, False, False)},
{hashed('hi', 'itm', 'p_partkey', 't', 1152, False, False)},
uc AS (SELECT k AS id, dim, v / sqrt(sum(v * v) OVER (PARTITION BY k)) AS v FROM hc),
ui AS (SELECT k AS query_id, dim, v / sqrt(sum(v * v) OVER (PARTITION BY k)) AS v FROM hi),
pairs AS (SELECT i.p_partkey AS query_id, c.id, c.label FROM itm i, cls c),
dots AS (SELECT query_id, id, sum(ui.v * uc.v) AS s FROM ui JOIN uc USING (dim) GROUP BY ALL),
near AS (SELECT * FROM (SELECT p.query_id, p.label, round(coalesce(s, 0), 9) AS score,
           row_number() OVER (PARTITION BY p.query_id ORDER BY round(coalesce(s, 0), 9) DESC, p.id) AS rank
         FROM pairs p LEFT JOIN dots USING (query_id, id)) WHERE rank <= 3),
{vote('near')}
SELECT query_id, label, round(prob, 6) AS prob FROM probs""",
    "k9_sample_per_class": """WITH c AS (SELECT label FROM (SELECT DISTINCT label FROM embeddings)
  ORDER BY md5('3:' || label), label LIMIT 4)
SELECT id, label FROM (SELECT vec_id AS id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS n
  FROM embeddings WHERE label IN (SELECT label FROM c)) WHERE n <= 10""",
    "k10_semantic_search": f"""WITH {parts_of('qs', 'benchmark', 'item_id', 'query: ')},
{parts_of('cs', 'documents', 'doc_id', 'passage: ')},
{hashed('hq', 'qs', 'k', 't', 1024, True, True)},
{hashed('hc', 'cs', 'k', 't', 1024, True, True)},
pairs AS (SELECT qs.k AS qk, cs.k AS ck, qs.id AS query_id, cs.id AS id FROM qs, cs),
dots AS (SELECT hq.k AS qk, hc.k AS ck, sum(hq.v * hc.v) AS s FROM hq JOIN hc USING (dim) GROUP BY ALL),
best AS (SELECT query_id, id, max(round(coalesce(s, 0), 9)) AS score FROM pairs LEFT JOIN dots USING (qk, ck) GROUP BY ALL),
near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank FROM best)
SELECT query_id, rank, id, round(score, 6) AS score FROM near WHERE rank <= 5""",
    "a1_lid_f1": f"""WITH {MODEL},
pg AS (SELECT page_id, regexp_extract(html, 'lang="([a-z]+)"', 1) AS code,
              regexp_replace(html, '<[^>]*>', ' ', 'g') AS text FROM pages),
{ranking('r', 'pg', 'page_id', 'text', PLAIN)},
rows_r AS (SELECT CASE code WHEN 'en' THEN 'eng' WHEN 'fr' THEN 'fra' WHEN 'es' THEN 'spa' WHEN 'de' THEN 'deu' END AS truth,
                  t.lang AS pred FROM pg LEFT JOIN ({top_of('r', 'page_id')}) t USING (page_id))
{report('rows_r')}""",
    "a2_golden_fraction": golden("string_split(replace(text, '. ', '.' || chr(2)), chr(2))", "lang"),
    "a3_topk_accuracy": f"""WITH {FEW_SHOT},
classes AS (SELECT DISTINCT label FROM embeddings),
full_p AS (SELECT i.id AS query_id, i.label AS truth, c.label, round(coalesce(p.prob, 0), 9) AS prob
           FROM items i CROSS JOIN classes c LEFT JOIN probs p ON p.query_id = i.id AND p.label = c.label),
pos AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY prob DESC, label DESC) AS rank FROM full_p)
SELECT count(*) AS n, round(avg((rank <= 1)::INTEGER), 6) AS top1, round(avg((rank <= 5)::INTEGER), 6) AS top5
FROM pos WHERE label = truth""",
    "a4_bitext_accuracy": f"""WITH {MARGINS}
SELECT (SELECT count(*) FROM best) AS n, (SELECT round(avg((id = query_id)::INTEGER), 6) FROM best) AS margin_accuracy,
  (SELECT round(avg((id = query_id)::INTEGER), 6) FROM cand WHERE rank = 1) AS cosine_accuracy""",
    "a5_weighted_mean": f"""WITH {RATED}, g AS (SELECT source, avg(quality) AS a, count(*) AS n FROM rated GROUP BY source)
SELECT round(sum(a * n) / sum(n), 6) AS weighted_mean FROM g""",
    "a6_chrf": "WITH pairs AS (SELECT conv_id, turn, role, text AS ref, "
    "replace(replace(text, 'tion', 't'), '.', ' .') AS hyp FROM conversations), "
    + chrf("pairs", "conv_id, turn", "role"),
    "a7_make_blocks": """WITH b AS (SELECT doc_id, text, doc_id // 60 AS batch,
  ntile(3) OVER (PARTITION BY doc_id // 60 ORDER BY doc_id) - 1 AS part FROM documents)
SELECT batch, part::INTEGER AS part, count(*) AS n, md5(string_agg(text, ' ' ORDER BY doc_id)) AS text_md5
FROM b GROUP BY batch, part""",
    "a8_mean_over_groups": f"""WITH {RATED},
e AS (SELECT DISTINCT source AS lang FROM documents),
j AS (SELECT e.lang, s.score FROM e LEFT JOIN scores s ON s.lang = e.lang AND s.use_src)
SELECT round(avg(score), 6) AS mean_score, count(score) AS n_scored,
  coalesce(string_agg(lang, ',' ORDER BY lang) FILTER (score IS NULL), '') AS failed FROM j""",
    "a9_latency_report": """SELECT event_type, count(value) AS n,
  round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE), 6) AS throughput,
  round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90,
  round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99
  FROM events GROUP BY event_type""",
    "a10_batch_efficiency": """SELECT event_type, count(*) AS n_rows, count(DISTINCT event_id // 50) AS n_batches,
  round(count(*)::DOUBLE / count(DISTINCT event_id // 50), 6) AS rows_per_batch FROM events GROUP BY event_type""",
    "a11_src_effect": f"""WITH {RATED}
SELECT lang, round(avg(score) FILTER (use_src), 6) AS with_src, round(avg(score) FILTER (NOT use_src), 6) AS without_src,
  round(avg(score) FILTER (use_src) - avg(score) FILTER (NOT use_src), 6) AS difference FROM scores GROUP BY lang""",
    "q1_translate": f"""WITH {MODEL}, {LEXICON},
early AS (SELECT *, {Q1_SOURCE} AS early FROM docs),
wanted AS (SELECT doc_id, text, {GIVEN} AS given, CASE WHEN source = 'src4' THEN 'tlh' ELSE 'eng' END AS tgt
           FROM early WHERE early IS NULL),
{translated('whole', 'wanted', 0.95, 'lexicon', f"""CASE
  WHEN src = 'deu' THEN '{TRANSLATED.format('source', 'src')}'
  WHEN tgt = 'tlh' THEN '{TRANSLATED.format('target', 'tgt')}' END""")}
SELECT e.doc_id, coalesce(early, message) AS message,
  CASE WHEN early IS NULL AND message IS NULL THEN md5(coalesce(t, '')) END AS text_md5
FROM early e LEFT JOIN whole USING (doc_id)""",
    "q2_embed_text": f"""WITH c AS (SELECT doc_id, source, {PREFIXED} AS t, CASE
    WHEN source = 'src1' THEN 'model' WHEN source IN ('src0', 'src2') THEN
      CASE WHEN {n_words(PREFIXED)} > 64 THEN 'tokens' END
    WHEN {n_words(PREFIXED)} > 512 THEN 'tokens' WHEN NOT {GOOD_PREFIX} THEN 'prefix' END AS error_stage FROM documents),
okd AS (SELECT * FROM c WHERE error_stage IS NULL AND source NOT IN ('src0', 'src2')),
okc AS (SELECT * FROM c WHERE error_stage IS NULL AND source IN ('src0', 'src2')),
{hashed('hd', 'okd', 'doc_id', 't', 1024, True, True)},
{hashed('hc', 'okc', 'doc_id', 't', 1152, False, False)},
f AS ({fingerprints('hd', 1024)} UNION ALL {fingerprints('hc', 1152)})
SELECT c.doc_id, n_dims, n_nonzero, ramp, error_stage FROM c LEFT JOIN f ON f.k = c.doc_id""",
    "q4_detect_language": f"""WITH {MODEL},
asked AS (SELECT doc_id, text, lang, source, CASE WHEN source = 'src1' THEN 'missing text'
    WHEN lang <> 'en' AND source = 'src3' THEN 'parameter top_k is no int' END AS message FROM docs),
good AS (SELECT doc_id, text FROM asked WHERE message IS NULL),
{ranking('r', 'good', 'doc_id', 'text', PER_GRAM)},
kept AS (SELECT r.* FROM r JOIN asked USING (doc_id)
         WHERE pos <= CASE WHEN lang = 'en' THEN 3 ELSE 1 END AND prob >= CASE WHEN lang = 'en' THEN 0.01 ELSE 0 END),
lists AS (SELECT doc_id, string_agg(split_part(label, '_', 1), ',' ORDER BY pos) AS langs,
            string_agg(split_part(label, '_', 2), ',' ORDER BY pos) AS scripts, round(max(prob), 6) AS best_prob
          FROM kept GROUP BY doc_id)
SELECT doc_id, langs, scripts, best_prob, message FROM asked LEFT JOIN lists USING (doc_id)""",
    "q5_segment": f"""WITH s AS (SELECT doc_id, source, {sentences('text', 'lang')} AS s FROM documents)
SELECT doc_id, CASE WHEN source <> 'src1' THEN len(s)::INTEGER END AS n_sentences,
  CASE WHEN source <> 'src1' THEN md5(array_to_string(s, chr(2))) END AS sentences_md5,
  CASE WHEN source = 'src1' THEN 'missing lang' END AS message FROM s""",
    "q6_mine_bitext": f"WITH {MARGINS} SELECT query_id, id, round(margin, 6) AS margin FROM best",
    "q7_classify_few_shot": f"""WITH {FEW_SHOT}
SELECT query_id, label, round(prob, 6) AS prob FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(prob, 6) DESC, label DESC) AS n FROM probs) WHERE n = 1""",
    "q8_evaluate_translation": f"""WITH {MODEL}, turns AS ({TURNS}),
{lexicon('turn_lexicon', TURN_SIDES)},
par AS (SELECT idx, 'eng' AS lang, text AS s FROM turns UNION ALL SELECT idx, 'fra', replace(text, 'en', 'an') FROM turns
  UNION ALL SELECT idx, 'cmn_Hant', replace(text, 'er', 'or') FROM turns
  UNION ALL SELECT idx, 'tlh', replace(text, 'the', 'tha') FROM turns),
b AS (SELECT *, idx // 60 AS batch, ntile(3) OVER (PARTITION BY lang, idx // 60 ORDER BY idx) AS part FROM par),
blk AS (SELECT lang, batch, part, string_agg(s, ' ' ORDER BY idx) AS t FROM b GROUP BY ALL),
{q8_run('yes', 'lang')}, {q8_run('no', "''")},
langs AS (SELECT DISTINCT lang FROM blk WHERE lang <> 'eng'),
both_runs AS (SELECT lang, y.score AS y, n.score AS n FROM langs LEFT JOIN yes y USING (lang) LEFT JOIN no n USING (lang))
SELECT lang, round(y, 6) AS with_src, round(n, 6) AS without_src, round(y - n, 6) AS difference, CAST(NULL AS VARCHAR) AS failed
FROM both_runs WHERE y IS NOT NULL OR n IS NOT NULL UNION ALL
SELECT 'mean', round(avg(y), 6), round(avg(n), 6), round(avg(y) - avg(n), 6),
  'with: ' || coalesce(string_agg(lang, ',' ORDER BY lang) FILTER (y IS NULL), '') || '; without: '
  || coalesce(string_agg(lang, ',' ORDER BY lang) FILTER (n IS NULL), '') FROM both_runs""",
    "q9_evaluate_lid": f"""WITH {MODEL}, {ranking('r', 'docs', 'doc_id', 'text', PLAIN)},
rows_r AS (SELECT d.lang3 AS truth, t.lang AS pred FROM docs d LEFT JOIN ({top_of('r', 'doc_id')}) t USING (doc_id))
{report('rows_r')}""",
    "q9_evaluate_segmenter": golden(
        "string_split(regexp_replace(text, '\\.[ \\n]', '.' || chr(2), 'g'), chr(2))", "lang"
    ),
    "t4_latency_windows": """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(value) AS n,
  round(avg(value), 6) AS mean, max(value) AS "max", quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.9) AS p90,
  quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY ALL""",
    "language_and_sentences": f"""WITH {MODEL}, {ranking('r', 'docs', 'doc_id', 'text', PLAIN)},
t AS ({top_of('r', 'doc_id')}),
i AS (SELECT text, {ISO_OF.format('t.lang')} AS iso1 FROM documents JOIN t USING (doc_id))
SELECT iso1 AS lang, count(*) AS n_docs, sum(len({sentences('text', 'iso1')}))::BIGINT AS n_sentences FROM i GROUP BY iso1""",
}

# Streams must equal the batch query of the same name.
ORACLE_SQL["t1_stream_requests"] = ORACLE_SQL["s1_read_requests"]
ORACLE_SQL["t2_stream_detect"] = ORACLE_SQL["m2_detect_language"]
ORACLE_SQL["t2_stream_segment"] = ORACLE_SQL["m4_segment"]
ORACLE_SQL["t4_stream_latency"] = ORACLE_SQL["t4_latency_windows"]
ORACLE_SQL["t2_stream_translate"] = ORACLE_SQL["q1_translate"]
ORACLE_SQL["t2_stream_embed"] = ORACLE_SQL["q2_embed_text"]
ORACLE_SQL["t3_guarded_requests"] = """SELECT event_id,
  CASE WHEN event_id % 6 = 2 THEN 'the request came after the watermark' END AS message FROM events"""
ORACLE_SQL["t3_split_sink"] = ORACLE_SQL["s7_write_results"]
# Both approximate searches have to reach the recall, with as many rows as there are neighbours.
ORACLE_SQL["k3_ann_knn"] = ORACLE_SQL["k3_compressed_knn"] = """
SELECT count(*) AS n_queries, least(10, count(*)) AS least, least(10, count(*)) AS most, TRUE AS recall_reached
FROM embeddings"""
# Probing every cell makes the approximate search exact.
ORACLE_SQL["k3_ann_all_cells"] = ORACLE_SQL["k2_knn"]
