"""Line dedup by log templates: lines that follow a template recurring across documents are dropped.

A parsing tree of fixed depth gives every line its path: the number of its words, then its first ``depth``
words; a word with a digit is a variable field at once, unless the line holds nothing else. Below its path a line is a sequence of ``SEGMENTS``
runs of words, and its templates are the line itself and the line with one run made variable, if at least
``FIXED`` words below the path stay fixed; a line of ``depth`` words or fewer is its path. So lines of equal length
and beginning that differ in one field, whatever stands in it, meet in one template, and no two
lines of a path need be compared. The line itself recurs if at least ``min_docs`` documents hold it. A template with a variable run
must also be followed in ``share`` of all documents with words, since by chance alone ever more documents of a growing corpus begin a line
alike. Each line of a recurring template goes but the first (by doc_id, then place), so its content stays once in the corpus.

Words stand between ASCII white space. Empty lines stay. Null texts stay null. Rows with the same doc_id and text are one document and are treated
alike. A null doc_id is a document of its own per text and comes first. A document may end up with an empty
text; no row is lost. An empty table stays empty. Columns other than ``doc_id`` and ``text`` are returned
unchanged.

Templates are compared as 64-bit hashes; only these are shuffled, with line numbers, and the text moves once,
to meet the numbers of its dropped lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.functions.rows import computed, explode
from docframe.session import written

SEGMENTS = 4
DEPTH = 3
MIN_DOCS = 10
#: Words below the path that a template with a variable run must keep.
FIXED = 3
#: Of all documents with words, those that must follow a template with a variable run.
SHARE = 0.0001
SPACE = r"[\x20\x09-\x0D]+"
OTHER_SPACE = r"[\x09-\x0D]"
#: A word with a digit, from its start on.
FIELD = r"(?<![^\x20])[^\x200-9]*+[0-9][^\x20]*+"


def _segments(words: Column, depth: int) -> list[Column]:
    """Hashes of the runs of words below the path."""
    rest = F.greatest(F.size(words) - depth, F.lit(0))
    edges = [F.lit(depth) + F.floor(rest * k / SEGMENTS).cast("int") for k in range(SEGMENTS + 1)]
    return [F.xxhash64(F.slice(words, edges[k] + 1, edges[k + 1] - edges[k])) for k in range(SEGMENTS)]


def parsed(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(doc_id, text_key, line, path, templates): every line with words, with the hashes of its path and of its templates, the line itself first."""
    # The hash of a text is worked out once, not again for each of its lines.
    split = computed(docs.filter("text is not null").select("doc_id", "text"), text_key=F.xxhash64("text"), parts=F.split("text", "\n"))
    lines = explode(split, ["doc_id", "text_key"], "parts", "content", pos="line")
    # Most lines have neither a digit nor white space but blanks, and are only split.
    content = F.col("content")
    masked = F.regexp_replace(F.regexp_replace(content, OTHER_SPACE, " "), FIELD, "0")
    named = F.when(masked.rlike(r"[^\x200]"), masked).otherwise(F.regexp_replace(content, OTHER_SPACE, " "))
    plain = F.when(content.rlike(r"[0-9\x09-\x0D]"), named).otherwise(content)
    lines = computed(lines, words=F.array_remove(F.split(plain, " "), "")).drop("content").filter(F.size("words") > 0)
    path = F.xxhash64(F.size("words"), F.slice("words", 1, depth))
    lines = lines.select("doc_id", "text_key", "line", F.struct(path.alias("path"), (F.size("words") - depth).alias("rest"), *(s.alias(f"s{k}") for k, s in enumerate(_segments(F.col("words"), depth)))).alias("t"))
    path, parts = F.col("t.path"), [F.col(f"t.s{k}") for k in range(SEGMENTS)]
    exact = F.xxhash64(path, *parts)
    masks = [F.xxhash64(F.lit(k), path, *(p for i, p in enumerate(parts) if i != k)) for k in range(SEGMENTS)]
    # The longest run is the last: where enough words stay beside it, they do beside each, and no run is empty.
    rest = F.col("t.rest")
    templates = F.when(rest - F.ceil(rest / SEGMENTS) >= FIXED, F.array(exact, *masks)).otherwise(F.array(exact))
    return lines.select("doc_id", "text_key", "line", path.alias("path"), templates.alias("templates"))


def dropped(docs: DataFrame, min_docs: int = MIN_DOCS, depth: int = DEPTH, share: float = SHARE) -> DataFrame:
    """(doc_id, text_key, lines): numbers of the lines that go, for each document that loses any."""
    lines = written(parsed(docs, depth), "templates")
    # Only paths that enough lines take can hold a template that recurs; the others' templates are never sent.
    taken = lines.groupBy("path").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs).select("path")
    kept = lines.join(taken, "path", "left_semi")
    rows = kept.select("doc_id", "text_key", "line", F.posexplode("templates").alias("k", "template")).select("doc_id", "text_key", "line", (F.col("k") > 0).alias("masked"), "template")
    # One row for each template and document before a template's documents are counted, so no task gets them all.
    per_doc = rows.groupBy("template", "masked", "doc_id", "text_key").agg(F.min("line").alias("line"))
    documents = lines.select("doc_id", "text_key").distinct().agg(F.count("*")).scalar()
    least = F.when(F.col("masked"), F.greatest(F.lit(min_docs), F.ceil(documents * share))).otherwise(F.lit(min_docs))
    recurring = per_doc.groupBy("template", "masked").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "text_key", "line")).alias("first")).filter(F.col("n") >= least).select("template", "first")
    here = F.struct("doc_id", "text_key", "line")
    later = rows.join(recurring, "template").filter(here > F.col("first")).select("doc_id", "text_key", "line")
    return later.groupBy("doc_id", "text_key").agg(F.collect_set("line").alias("lines"))


def dedup(docs: DataFrame, min_docs: int = MIN_DOCS, depth: int = DEPTH, counts: bool = False, share: float = SHARE) -> DataFrame:
    """``docs`` with the recurring lines taken out of ``text``; on wish ``n_lines`` and ``n_dropped`` beside it."""
    gone = dropped(docs, min_docs, depth, share).select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key"), F.col("lines").alias("_gone_lines"))
    both = docs.join(gone, docs["doc_id"].eqNullSafe(F.col("_gone_id")) & (F.xxhash64(docs["text"]) == F.col("_gone_key")), "left")
    # The numbers that stay are found with one hash set a document, and its lines are looked up by number.
    both = computed(both, _gone_split=F.when(F.col("_gone_lines").isNotNull(), F.split(docs["text"], "\n")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_gone_split") - 1), F.col("_gone_lines"))
    rest = F.array_join(F.transform(stay, lambda i: F.get(F.col("_gone_split"), i)), "\n")
    text = F.when(F.col("_gone_lines").isNull(), docs["text"]).otherwise(rest)
    out = [text.alias("text") if c == "text" else docs[c] for c in docs.columns]
    if counts:
        n = F.when(docs["text"].isNull(), F.lit(0)).otherwise(F.size(F.split(docs["text"], "\n")))
        out += [n.cast("long").alias("n_lines"), F.coalesce(F.size("_gone_lines"), F.lit(0)).cast("long").alias("n_dropped")]
    return both.select(*out)


def oracle() -> str:
    """The dedup in DuckDB's SQL, with templates as texts."""
    edges = [f"({DEPTH} + greatest(len(w) - {DEPTH}, 0) * {k} // {SEGMENTS})" for k in range(SEGMENTS + 1)]
    parts = [f"array_to_string(list_slice(w, {edges[k]} + 1, {edges[k + 1]}), ' ')" for k in range(SEGMENTS)]
    whole = ["s0", "s1", "s2", "s3"]
    masks = [["chr(0)" if i == k else s for i, s in enumerate(whole)] for k in range(SEGMENTS)]

    def form(k: int, runs: list[str]) -> str:
        return "concat_ws(chr(1), len(w), " + ", ".join(runs) + f", list_slice(w, 1, {DEPTH}), {k})"

    exact, forms = form(0, whole), ", ".join(form(k, m) for k, m in enumerate(masks, 1))
    return f"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS content,
             generate_subscripts(string_split(text, chr(10)), 1) AS line FROM d),
v AS (SELECT doc_id, text, line, list_filter(regexp_split_to_array(content, '{SPACE}'), lambda x: x <> '') AS w FROM l),
w AS (SELECT doc_id, text, line, CASE WHEN len(list_filter(w, lambda x: NOT regexp_matches(x, '[0-9]'))) = 0 THEN w
             ELSE list_transform(w, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '0' ELSE x END) END AS w FROM v),
s AS (SELECT *, {", ".join(f"{p} AS s{k}" for k, p in enumerate(parts))} FROM w WHERE len(w) > 0),
r AS (SELECT doc_id, text, line, unnest([{exact}]) AS template, false AS masked FROM s
      UNION ALL SELECT doc_id, text, line, unnest([{forms}]), true FROM s
      WHERE len(w) - {DEPTH} - ceil((len(w) - {DEPTH}) / {SEGMENTS}) >= {FIXED}),
n AS (SELECT count(*) AS n FROM (SELECT DISTINCT doc_id, text FROM s)),
t AS (SELECT template, min({{'d': doc_id, 'l': line}}) AS first FROM r GROUP BY template, masked
      HAVING count(DISTINCT doc_id) >= CASE WHEN masked THEN greatest({MIN_DOCS}, (SELECT ceil(n * {SHARE}) FROM n)) ELSE {MIN_DOCS} END),
g AS (SELECT DISTINCT doc_id, text, line FROM r JOIN t USING (template) WHERE {{'d': doc_id, 'l': line}} > first),
k AS (SELECT l.doc_id, l.text, coalesce(string_agg(content, chr(10) ORDER BY l.line) FILTER (g.line IS NULL), '') AS rest,
             count(*) AS n_lines, count(g.line) AS n_dropped
      FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.text = g.text AND l.line = g.line GROUP BY l.doc_id, l.text)
SELECT x.doc_id, k.rest AS text, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped
FROM documents x LEFT JOIN k ON x.doc_id = k.doc_id AND x.text = k.text
"""
