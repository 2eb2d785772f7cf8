"""Queries over Markdown documents, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from docframe.functions.text import inline_plain_text
from docframe.operators import assemble, cleanup, diff, headings, prompts, quality, segments
from docframe.plans import fragments as page_plans
from docframe.plans.corpora import fragments, md_docs, raw_docs, spread, table
from docframe.session import work_folder
from docframe.sources.files import scan_markdown, write_markdown

NL = "chr(10)"


def plain_sql(x: str) -> str:
    inline = (
        r"\*\*(.+?)\*\*|__(.+?)__|\*(.+?)\*|_(.+?)_|`([^`]+)`|\[([^\]]+)\]\([^\)]+\)"
    )
    return (
        rf"trim(regexp_replace(regexp_replace({x}, '{inline}', '\1\2\3\4\5\6', 'g'), '\s+', ' ', 'g'))"
    )


SEP = r"^\|[\s\-:|]+\|[\s\-:|]*$"
ROW = (
    "array_to_string(list_filter(list_transform(list_filter(string_split(s, '|'), "
    f"lambda c: trim(c) <> ''), lambda c: {plain_sql('c')}), lambda c: c <> ''), ' | ')"
)

RAW_LINES = f"""
raw_lines AS (
  SELECT doc_id, source, lang, unnest(ls) AS raw, generate_subscripts(ls, 1) - 1 AS pos
  FROM (SELECT doc_id, source, lang, string_split(text, {NL}) AS ls FROM documents)
)"""

H = "(doc_id * 31 + (i - 1) * 17) % 13"
MD_LINES = f"""
md_lists AS (
  SELECT doc_id, lang, CASE doc_id % 3 WHEN 0 THEN 6 WHEN 1 THEN 4 ELSE 0 END AS front, list_concat(
    CASE doc_id % 3 WHEN 0 THEN ['---', concat('titolo: Documento ', doc_id), 'comune: Como', concat('tipo: ', lang), 'anno: 2020', '---', '']
      WHEN 1 THEN ['---', concat('titolo: Documento ', doc_id), 'anno: 2020', '---'] ELSE [] END,
    flatten(list_transform(string_split(text, {NL}), lambda line, i: list_concat(
      CASE WHEN i = 1 THEN [] WHEN {H} = 0 THEN [concat('## Parte ', i - 1)] WHEN {H} = 1 THEN [concat('### Capo ', i - 1)]
        WHEN {H} = 2 THEN [concat('#### Voce ', i - 1)] WHEN {H} = 3 THEN [concat('##### Nota ', i - 1)] WHEN {H} = 4 THEN ['']
        WHEN {H} = 5 THEN [concat('| ', replace(line, '|', ''), ' |  | x', i - 1, ' |'), '|---|---|---|',
          CASE WHEN (i - 1) % 4 = 0 THEN '| uno | due |' ELSE '| uno | *due* | tre |' END]
        WHEN {H} = 6 THEN ['|---|---|']
        WHEN {H} = 9 THEN [CASE WHEN (i - 1) % 2 = 0 THEN '![a](img/p.png)' ELSE '![b](http://x/p.png)' END]
        WHEN {H} = 10 THEN [concat('<!-- UNREADABLE: page ', i - 1, ' -->')] ELSE [] END,
      [CASE WHEN i = 1 THEN concat('# ', line) WHEN {H} = 7 THEN concat('- ', line) WHEN {H} = 8 THEN concat('**', line, '**')
        ELSE line END])))) AS out FROM documents
),
md_lines AS (
  SELECT doc_id, front, unnest(out) AS line, generate_subscripts(out, 1) - 1 AS pos FROM md_lists
),
kept_lines AS (
  SELECT doc_id, pos, line FROM (
    SELECT *, max(pos) OVER (PARTITION BY doc_id) AS last_pos FROM md_lines)
  WHERE NOT (pos = last_pos AND line = '')
)"""

SEGMENTS = rf"""{MD_LINES},
classified AS (
  SELECT doc_id, pos, s, CASE
    WHEN regexp_matches(s, '^#{{1,6}}\s+') THEN 'h'
    WHEN starts_with(s, '|') THEN CASE WHEN regexp_matches(s, '{SEP}') THEN 'b' ELSE 't' END
    WHEN s = '' OR starts_with(s, '<!--') THEN 'b' ELSE 'p' END AS kind
  FROM (SELECT doc_id, pos, trim(line) AS s FROM md_lines WHERE pos >= front)
),
islands AS (
  SELECT *, sum(CASE WHEN kind = 'p' AND before = 'p' THEN 0 ELSE 1 END)
    OVER (PARTITION BY doc_id ORDER BY pos) AS island
  FROM (SELECT *, lag(kind) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM classified)
),
segs AS (
  SELECT doc_id, island, CASE max(kind)
    WHEN 't' THEN max({ROW})
    ELSE {plain_sql(r"regexp_replace(string_agg(s, ' ' ORDER BY pos), '^#{1,6}\s+', '')")} END AS segment
  FROM islands WHERE kind <> 'b' GROUP BY doc_id, island
),
numbered AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY island) AS INTEGER) AS tuid, segment
  FROM segs WHERE segment <> ''
)"""

UNIT = (
    f"concat('    <tu tuid=\"', tuid, '\">', {NL}, '      <tuv xml:lang=\"it\"><seg>', "
    "replace(replace(replace(segment, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), "
    f"'</seg></tuv>', {NL}, '      <tuv xml:lang=\"en\"><seg></seg></tuv>', {NL}, '    </tu>', {NL})"
)

HEADS = rf"""{MD_LINES},
heads AS (
  SELECT *, lag(level) OVER (PARTITION BY doc_id ORDER BY pos) AS previous,
    lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS next_pos FROM (
    SELECT doc_id, pos, line, length(regexp_extract(line, '^(#{{1,4}})\s', 1)) AS level FROM kept_lines)
  WHERE level > 0
)"""

RAW_VARIANTS = f"""{RAW_LINES},
extra AS (
  SELECT doc_id, source, lang, pos, CASE
    WHEN pos % 11 = 10 THEN CAST(pos AS VARCHAR)
    WHEN pos % 13 = 12 THEN concat('Rilascio della autorizzazione ', pos, ' dalla autorità competente')
    WHEN pos % 17 = 16 THEN concat('Copyright ', doc_id)
    WHEN pos % 19 = 18 THEN concat('ART. ', pos, ' ........ ', pos)
    WHEN pos % 23 = 22 THEN concat('TITOLO ', pos)
    WHEN pos % 29 = 28 THEN concat('ART. ', pos, ' Disposizioni')
    WHEN pos % 31 = 30 THEN concat(pos, '.1 Generale')
    WHEN pos % 37 = 36 THEN 'È vietato il deposito'
    WHEN pos % 41 = 40 THEN 'Autori: A. Rossi'
    WHEN pos % 43 = 42 THEN 'Vietata la riproduzione anche parziale' END AS line
  FROM raw_lines
),
variants AS (
  SELECT doc_id, source, lang, 2 * pos AS place, pos, line FROM extra WHERE line IS NOT NULL
  UNION ALL SELECT doc_id, source, lang, 2 * pos + 1, pos, raw FROM raw_lines
)"""


def _cleaned(spark, sf, name, fn):
    return raw_docs(spark, sf).select("doc_id", fn(F.col("text")).alias(name))


def _scan_markdown(spark, sf):
    """Write a Markdown file per document to the shared folder and scan them back."""
    folder = work_folder(spark, "markdown")
    named = md_docs(spark, sf).select("doc_id", F.concat(F.lit("doc_"), "doc_id").alias("source_file"), "md")
    write_markdown(named, folder)
    return scan_markdown(spark, folder).select("source_file", "md", (F.length("doc_id") == 32).alias("keyed"))


def _parts(spark, sf):
    """Documents of two pages a part, as ``md_documents`` gives them."""
    return assemble.md_documents(assemble.clean_fragments(fragments(spark, sf)), 2).drop("source_file")


def _pieces(df, no, *columns):
    """Sections or chunks of documents in parts, their pieces put together."""
    text = columns[-1]
    return df.groupBy("doc_id", no).agg(
        *[F.min(c).alias(c) for c in columns[:-1] if c != "last_line"],
        F.max("last_line").alias("last_line"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece_no", text))), lambda p: p[text]), "\n").alias(text),
    )


def _tmx_parts(spark, sf):
    tmx = segments.tmx_documents(_parts(spark, sf), "it", "en", "20250101T000000Z")
    return tmx.groupBy("doc_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part_no", "tmx"))), lambda p: p["tmx"]), "").alias("tmx")
    )


def _checks(spark, sf, docs=None):
    return quality.quality_checklist(md_docs(spark, sf) if docs is None else docs).withColumn(
        "unreadable_pages", F.array_join(F.col("unreadable_pages").cast("array<string>"), ",")
    )


def _title_lengths(spark, sf):
    return spread(table(spark, sf, "pages")).select(
        "page_id",
        inline_plain_text(
            F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
        ).alias("title"),
        inline_plain_text(
            F.regexp_replace("html", r"<[^>]*>", " ")
        ).alias("text"),
    )


QUERIES = {
    "segments": lambda s, d: segments.segments(md_docs(s, d)),
    "table_row_segments": lambda s, d: segments.table_row_segments(md_docs(s, d)),
    "tmx_units": lambda s, d: segments.tmx_units(md_docs(s, d), "it", "en"),
    "tmx_documents": lambda s, d: segments.tmx_documents(md_docs(s, d), "it", "en", "20250101T000000Z"),
    "translation_csv": lambda s, d: segments.translation_csv(md_docs(s, d), "it", "en"),
    "inline_plain_text": _title_lengths,
    "heading_skips": lambda s, d: headings.heading_skips(md_docs(s, d)),
    "fix_heading_skips": lambda s, d: headings.fix_heading_skips(md_docs(s, d)),
    "sections": lambda s, d: headings.sections(md_docs(s, d)),
    "chunks": lambda s, d: headings.chunks(md_docs(s, d), lines_per_chunk=20),
    "drop_boilerplate_lines": lambda s, d: _cleaned(s, d, "text", cleanup.drop_boilerplate_lines),
    "normalize_toc": lambda s, d: _cleaned(s, d, "text", cleanup.normalize_toc),
    "classify_headings": lambda s, d: _cleaned(
        s, d, "text", lambda c: cleanup.classify_headings(cleanup.normalize_toc(c))
    ),
    "quality_checklist": _checks,
    "segments_of_parts": lambda s, d: segments.segments(_parts(s, d)),
    "tmx_of_parts": _tmx_parts,
    "heading_skips_of_parts": lambda s, d: headings.heading_skips(
        assemble.assemble_documents(assemble.clean_fragments(fragments(s, d)), 2)
    ),
    "sections_of_parts": lambda s, d: _pieces(
        headings.sections(_parts(s, d)), "section_no", "level", "title", "path", "first_line", "last_line", "body"
    ),
    "requests_of_lines": lambda s, d: prompts.requests(
        spread(table(s, d, "documents")).select("doc_id", F.coalesce("text", F.lit("")).alias("text")), 300, lines=True
    ),
    "greedy_chunks": lambda s, d: headings.greedy_chunks(md_docs(s, d), lines_per_chunk=20),
    "greedy_chunks_of_parts": lambda s, d: _pieces(
        headings.greedy_chunks(_parts(s, d), lines_per_chunk=10), "chunk_no", "first_line", "last_line", "text"
    ),
    "chunks_of_parts": lambda s, d: _pieces(
        headings.chunks(_parts(s, d), lines_per_chunk=10), "chunk_no", "first_line", "last_line", "text"
    ),
    "checklist_of_parts": lambda s, d: _checks(s, d, _parts(s, d)),
    "corpus_quality": lambda s, d: quality.corpus_quality(
        quality.quality_checklist(md_docs(s, d)),
        md_docs(s, d).select("doc_id", F.coalesce(F.nullif(F.regexp_extract("md", r"\Atipo: (.*)|\ntipo: (.*)", 2), F.lit("")), F.lit("UNKNOWN")).alias("kind")),
    ),
    "ordered_diff": lambda s, d: diff.ordered_diff(md_docs(s, d), headings.fix_heading_skips(md_docs(s, d))).na.fill(0),
    "line_diff": lambda s, d: quality.line_diff(
        md_docs(s, d), headings.fix_heading_skips(md_docs(s, d))
    ),
    "split_glued_words": lambda s, d: quality.split_glued_words(spread(table(s, d, "documents"))),
    "repaired_words": lambda s, d: quality.repair_glued_words(
        spread(table(s, d, "documents")), quality.split_glued_words(spread(table(s, d, "documents")))
    ),
    "repeated_lines": lambda s, d: cleanup.repeated_lines(_sourced(s, d), share=0.1),
    "drop_repeated_lines": lambda s, d: cleanup.drop_repeated_lines(_sourced(s, d), share=0.1),
    "scan_markdown": _scan_markdown,
}


def _sourced(spark, sf):
    return spread(table(spark, sf, "documents")).select(
        F.col("source").alias("doc_id"), F.col("doc_id").alias("page_number"), "text"
    )


FIXED = f"""{HEADS},
fixed AS (
  SELECT l.doc_id, l.pos, 1 AS sub, l.line FROM kept_lines l
  UNION ALL
  SELECT doc_id, pos, 0, concat(repeat('#', previous + 1), ' (continued)') FROM heads
  WHERE previous IS NOT NULL AND level = previous + 2
)"""

CHECKS = rf"""{HEADS},
outline AS (
  SELECT doc_id, count(*) FILTER (level = 1) = 1 AS one_title,
    count(*) FILTER (level > previous + 1) = 0 AS no_skips FROM heads GROUP BY doc_id
),
widths AS (
  SELECT doc_id, pos, CASE WHEN starts_with(s, '|') THEN len(string_split(s, '|')) - 2 ELSE 0 END AS w
  FROM (SELECT doc_id, pos, trim(line) AS s FROM kept_lines) WHERE NOT regexp_matches(s, '{SEP}')
),
uneven AS (
  SELECT doc_id, bool_or(w > 0 AND p > 0 AND w <> p) AS bad
  FROM (SELECT doc_id, w, coalesce(lag(w) OVER (PARTITION BY doc_id ORDER BY pos), 0) AS p FROM widths)
  GROUP BY doc_id
),
checks AS (
  SELECT d.doc_id, d.doc_id % 3 = 0 AS front_matter, coalesce(one_title, false) AS one_title, coalesce(no_skips, true) AS no_skips,
    NOT coalesce(bad, false) AS tables_consistent, NOT coalesce(linked, false) AS images_relative, coalesce(pages, '') AS unreadable_pages
  FROM documents d LEFT JOIN outline o ON d.doc_id = o.doc_id LEFT JOIN uneven u ON d.doc_id = u.doc_id
  LEFT JOIN (SELECT doc_id, bool_or(line = '![b](http://x/p.png)') AS linked,
      string_agg(regexp_extract(line, 'page (\d+) -->', 1), ',' ORDER BY pos) FILTER (starts_with(line, '<!-- UNREADABLE')) AS pages
    FROM kept_lines GROUP BY doc_id) m ON d.doc_id = m.doc_id
)"""

WORDS = r"""
words AS (
  SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents
),
freq AS (SELECT word, count(*) AS df FROM words GROUP BY word),
cuts AS (
  SELECT word, CAST(p AS INTEGER) AS p, substring(word, 1, p) AS a, substring(word, p + 1) AS b
  FROM (SELECT word, unnest(generate_series(2, length(word) - 2)) AS p FROM freq
        WHERE df < 5 AND length(word) >= 4)
),
best AS (
  SELECT cuts.word, a AS first, b AS second, p, least(f.df, g.df) AS score,
    row_number() OVER (PARTITION BY cuts.word ORDER BY least(f.df, g.df) DESC, p) AS r
  FROM cuts JOIN freq f ON f.word = a AND f.df >= 5 JOIN freq g ON g.word = b AND g.df >= 5
)"""

REPEATED = f"""
page_lines AS (
  SELECT source AS doc_id, doc_id AS page_number, unnest(ls) AS raw, generate_subscripts(ls, 1) AS pos
  FROM (SELECT source, doc_id, string_split(text, {NL}) AS ls FROM documents)
),
repeated AS (
  SELECT l.doc_id, line, count(DISTINCT page_number) AS n_pages, min(page_number) AS first_page
  FROM (SELECT doc_id, page_number, trim(raw) AS line FROM page_lines) l
  JOIN (SELECT source AS doc_id, count(*) AS total FROM documents GROUP BY 1) t ON l.doc_id = t.doc_id
  WHERE line <> '' GROUP BY l.doc_id, line, total
  HAVING count(DISTINCT page_number) >= 3 AND count(DISTINCT page_number) >= total * 0.1
)"""

SECTIONS = rf"""ends AS (SELECT doc_id, max(pos) AS last_pos FROM kept_lines GROUP BY doc_id),
        cut AS (SELECT h.doc_id, h.pos, h.level, trim(regexp_replace(line, '^#+\s+', '')) AS title,
            coalesce(next_pos - 1, last_pos) AS end_pos,
            row_number() OVER (PARTITION BY h.doc_id ORDER BY h.pos) AS section_no
          FROM heads h JOIN ends e ON h.doc_id = e.doc_id),
        bodies AS (SELECT c.doc_id, section_no, string_agg(l.line, {NL} ORDER BY l.pos) AS body
          FROM cut c JOIN kept_lines l ON l.doc_id = c.doc_id AND l.pos > c.pos AND l.pos <= c.end_pos
          GROUP BY c.doc_id, section_no),
        parents AS (SELECT a.doc_id, a.section_no, b.level, arg_max(b.title, b.section_no) AS title,
            max(b.section_no) AS at
          FROM cut a JOIN cut b ON a.doc_id = b.doc_id AND b.section_no <= a.section_no AND b.level <= a.level
          GROUP BY a.doc_id, a.section_no, b.level),
        valid AS (SELECT p.doc_id, p.section_no, p.level, p.title FROM parents p
          WHERE NOT EXISTS (SELECT 1 FROM parents q WHERE q.doc_id = p.doc_id
            AND q.section_no = p.section_no AND q.level < p.level AND q.at > p.at)),
        paths AS (SELECT doc_id, section_no, string_agg(title, ' > ' ORDER BY level) AS path
          FROM valid GROUP BY doc_id, section_no)
        SELECT c.doc_id, c.section_no, CAST(c.level AS INTEGER) AS level, c.title, p.path,
          CAST(c.pos + 1 AS INTEGER) AS first_line, CAST(c.end_pos + 1 AS INTEGER) AS last_line, coalesce(b.body, '') AS body
        FROM cut c JOIN paths p ON p.doc_id = c.doc_id AND p.section_no = c.section_no
        LEFT JOIN bodies b ON b.doc_id = c.doc_id AND b.section_no = c.section_no"""

CHUNKS = f"""
        starts AS (SELECT doc_id, pos FROM heads UNION SELECT DISTINCT doc_id, 0 FROM kept_lines),
        chunk_starts AS (SELECT doc_id, min(pos) AS pos FROM starts GROUP BY doc_id, pos // PER_CHUNK),
        bounds AS (SELECT doc_id, pos, row_number() OVER w - 1 AS chunk_no,
            lead(pos) OVER w AS next_pos FROM chunk_starts WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
        SELECT b.doc_id, chunk_no, b.pos + 1 AS first_line, max(l.pos) + 1 AS last_line,
            string_agg(l.line, {NL} ORDER BY l.pos) AS text
        FROM bounds b JOIN kept_lines l ON l.doc_id = b.doc_id AND l.pos >= b.pos
            AND (next_pos IS NULL OR l.pos < next_pos)
        GROUP BY b.doc_id, chunk_no, b.pos"""

# Each cut hangs on the one before.
GREEDY = CHUNKS.replace("chunk_starts AS (SELECT doc_id, min(pos) AS pos FROM starts GROUP BY doc_id, pos // PER_CHUNK)", """chunk_starts AS (
            SELECT DISTINCT doc_id, 0 AS pos FROM kept_lines
            UNION ALL SELECT c.doc_id, (SELECT min(h.pos) FROM heads h WHERE h.doc_id = c.doc_id AND h.pos >= c.pos + PER_CHUNK)
            FROM chunk_starts c WHERE EXISTS (SELECT 1 FROM heads h WHERE h.doc_id = c.doc_id AND h.pos >= c.pos + PER_CHUNK))""")

ORACLES = {
    "segments": f"WITH {SEGMENTS} SELECT * FROM numbered",
    "table_row_segments": f"""WITH {MD_LINES} SELECT doc_id, CAST(pos + 1 AS INTEGER) AS line_no, segment FROM (
        SELECT doc_id, pos, s, {ROW} AS segment FROM (SELECT doc_id, pos, trim(line) AS s FROM md_lines)
        WHERE starts_with(s, '|') AND NOT regexp_matches(s, '{SEP}')) WHERE segment <> ''""",
    "tmx_units": f"WITH {SEGMENTS} SELECT doc_id, tuid, {UNIT} AS unit FROM numbered",
    "tmx_documents": f"""WITH {SEGMENTS} SELECT doc_id, concat(
        '<?xml version="1.0" encoding="utf-8"?>', {NL}, '<!DOCTYPE tmx SYSTEM "tmx14.dtd">', {NL},
        '<tmx version="1.4">', {NL},
        '  <header creationtool="docframe" creationtoolversion="1.0"', {NL},
        '          datatype="plaintext" segtype="paragraph"', {NL},
        '          adminlang="en-US" srclang="it"', {NL},
        '          creationdate="20250101T000000Z"/>', {NL}, '  <body>', {NL},
        string_agg({UNIT}, '' ORDER BY tuid), '  </body>', {NL}, '</tmx>', {NL}) AS tmx
        FROM numbered GROUP BY doc_id""",
    "translation_csv": f"WITH {SEGMENTS} SELECT doc_id, tuid AS id, segment AS it, '' AS en FROM numbered",
    "inline_plain_text": f"""SELECT page_id,
        {plain_sql("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS title,
        {plain_sql("regexp_replace(html, '<[^>]*>', ' ', 'g')")} AS text FROM pages""",
    "heading_skips": f"""WITH {HEADS} SELECT doc_id, CAST(pos + 1 AS INTEGER) AS line_no,
        CAST(previous AS INTEGER) AS previous_level, CAST(level AS INTEGER) AS level,
        concat('Line ', pos + 1, ': heading level skips from ', previous, ' to ', level, ' — ''', trim(line), '''') AS message
        FROM heads WHERE level > previous + 1""",
    "fix_heading_skips": f"""WITH {FIXED}
        SELECT doc_id, string_agg(line, {NL} ORDER BY pos, sub) AS md FROM fixed GROUP BY doc_id""",
    "sections": f"WITH {HEADS}, {SECTIONS}",
    "requests_of_lines": """WITH RECURSIVE cut AS (
          SELECT doc_id, -1 AS request_no, '' AS text, coalesce(text, '') AS rest, true AS more FROM documents
          UNION ALL
          SELECT doc_id, request_no + 1, left(rest, n), substring(rest, n + 1), length(rest) > n FROM (
            SELECT *, CASE WHEN length(rest) <= 300 THEN length(rest)
                WHEN contains(head, chr(10)) THEN 301 - strpos(reverse(head), chr(10))
                WHEN regexp_matches(head, '\\s') THEN 300 - length(regexp_extract(head, '[^\\s]*$'))
                ELSE 300 END AS n
            FROM (SELECT *, left(rest, 300) AS head FROM cut WHERE more)))
        SELECT doc_id, request_no, text FROM cut WHERE request_no >= 0""",
    "greedy_chunks": f"WITH RECURSIVE {HEADS}, " + GREEDY.replace("PER_CHUNK", "20"),
    "chunks": f"WITH {HEADS}, " + CHUNKS.replace("PER_CHUNK", "20"),
    "drop_boilerplate_lines": rf"""WITH {RAW_VARIANTS} SELECT doc_id, coalesce(string_agg(line, {NL} ORDER BY place)
        FILTER (NOT regexp_matches(trim(line), '^\d+$')
          AND NOT regexp_matches(lower(line), '^\W*copyright\b|^\W*autori\s*:|\bvietata\b.*\briproduzione\b')), '') AS text
        FROM variants GROUP BY doc_id""",
    "normalize_toc": f"""WITH {RAW_VARIANTS} SELECT doc_id, string_agg(
        CASE WHEN line = concat('ART. ', pos, ' ........ ', pos) THEN concat('- ART. ', pos) ELSE line END,
        {NL} ORDER BY place) AS text FROM variants GROUP BY doc_id""",
    "classify_headings": rf"""WITH {RAW_VARIANTS} SELECT doc_id, string_agg(CASE
        WHEN pos = 0 AND trim(line) <> '' THEN concat('# ', trim(line))
        WHEN line = concat('ART. ', pos, ' ........ ', pos) THEN concat('- ART. ', pos)
        WHEN regexp_matches(trim(line), '^TITOLO\s') THEN concat('## ', trim(line))
        WHEN regexp_matches(trim(line), '^(ART\.|CAPO\s)') THEN concat('### ', trim(line))
        WHEN regexp_matches(trim(line), '^\d+\.\d+\s') THEN concat('#### ', trim(line))
        ELSE line END, {NL} ORDER BY place) AS text FROM variants GROUP BY doc_id""",
    "quality_checklist": f"WITH {CHECKS} SELECT * FROM checks",
    "corpus_quality": f"""WITH {CHECKS}, kinds AS (
          SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang ELSE 'UNKNOWN' END AS kind FROM documents)
        SELECT CASE WHEN grouping(kind) = 1 THEN 'all' ELSE kind END AS kind, count(*) AS documents,
          round(avg(CAST(front_matter AS INTEGER)), 6) AS front_matter,
          round(avg(CAST(one_title AS INTEGER)), 6) AS one_title, round(avg(CAST(no_skips AS INTEGER)), 6) AS no_skips,
          round(avg(CAST(tables_consistent AS INTEGER)), 6) AS tables_consistent,
          round(avg(CAST(unreadable_pages = '' AS INTEGER)), 6) AS all_readable,
          round(avg(CAST(no_skips AS INTEGER)), 6) >= 0.9 AS accepted
        FROM checks c JOIN kinds k ON c.doc_id = k.doc_id GROUP BY ROLLUP (kind)""",
    "line_diff": f"""WITH {FIXED}, a AS (SELECT doc_id, line, count(*) AS n FROM kept_lines GROUP BY 1, 2),
        b AS (SELECT doc_id, line, count(*) AS n FROM fixed GROUP BY 1, 2)
        SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.line, b.line) AS line,
          coalesce(a.n, 0) AS n_left, coalesce(b.n, 0) AS n_right
        FROM a FULL JOIN b ON a.doc_id = b.doc_id AND a.line = b.line
        WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""",
    "ordered_diff": f"""WITH {FIXED} SELECT doc_id, 'added' AS change, 0 AS left_line, CAST(rn AS INTEGER) AS right_line, line
        FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos, sub) AS rn FROM fixed) WHERE sub = 0""",
    "split_glued_words": f"WITH {WORDS} SELECT word, first, second, score FROM best WHERE r = 1",
    "repaired_words": rf"""WITH {WORDS}, cut AS (SELECT word, p FROM best WHERE r = 1), {RAW_LINES},
        pieces AS (SELECT doc_id, pos, unnest(ps) AS piece, generate_subscripts(ps, 1) AS nth FROM (
          SELECT doc_id, pos, regexp_extract_all(raw, '\p{{L}}+|[^\p{{L}}]+') AS ps FROM raw_lines)),
        mended AS (SELECT doc_id, pos, nth, CASE WHEN p IS NULL THEN piece
            ELSE concat(substring(piece, 1, p), ' ', substring(piece, p + 1)) END AS piece, p
          FROM pieces LEFT JOIN cut ON lower(piece) = word)
        SELECT doc_id, CAST(pos AS INTEGER) AS line_no, string_agg(piece, '' ORDER BY nth) AS line
        FROM mended GROUP BY doc_id, pos HAVING bool_or(p IS NOT NULL)""",
    "repeated_lines": f"WITH {REPEATED} SELECT * FROM repeated",
    "drop_repeated_lines": f"""WITH {REPEATED},
        marked AS (SELECT l.*, r.first_page,
            row_number() OVER (PARTITION BY l.doc_id, l.page_number, trim(raw) ORDER BY pos) AS nth
          FROM page_lines l LEFT JOIN repeated r ON l.doc_id = r.doc_id AND trim(l.raw) = r.line)
        SELECT doc_id, page_number, coalesce(string_agg(raw, {NL} ORDER BY pos)
          FILTER (first_page IS NULL OR (first_page = page_number AND nth = 1)), '') AS text
        FROM marked GROUP BY doc_id, page_number""",
    "scan_markdown": f"""WITH {MD_LINES} SELECT concat('doc_', doc_id, '.md') AS source_file,
        string_agg(line, {NL} ORDER BY pos) AS md, true AS keyed FROM md_lines GROUP BY doc_id""",
}

# The same checks over documents that come in parts; the SQL knows whole ones only.
WHOLE = f"""WITH {page_plans.FRAGMENTS}, {page_plans.META},
whole AS (SELECT f.c AS doc_id, concat(head, f.body, {NL}) AS md, head FROM fixed f JOIN bodies b ON f.c = b.c),
md_lines AS (
  SELECT doc_id, 6 AS front, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos
  FROM (SELECT doc_id, string_split(md, {NL}) AS ls FROM whole)
),
kept_lines AS (
  SELECT doc_id, pos, line FROM (SELECT *, max(pos) OVER (PARTITION BY doc_id) AS last_pos FROM md_lines)
  WHERE NOT (pos = last_pos AND line = '')
)"""


def _of_parts(sql: str) -> str:
    """A query over ``md_lines`` of the documents table, over those of the assembled ones."""
    return WHOLE + sql.removeprefix(f"WITH {MD_LINES}").replace("heads AS (", "outlines AS (").replace("heads", "outlines").replace("outoutlines", "outlines")


ORACLES |= {
    "segments_of_parts": _of_parts(ORACLES["segments"]),
    "tmx_of_parts": _of_parts(ORACLES["tmx_documents"]),
    "heading_skips_of_parts": _of_parts(ORACLES["heading_skips"]).replace("FROM fixed f JOIN bodies b ON f.c = b.c", "FROM bodies f JOIN bodies b ON f.c = b.c").replace("AS md, head FROM", "AS md, b.head FROM").replace("concat(head,", "concat(b.head,"),
    "sections_of_parts": _of_parts(ORACLES["sections"].replace("bodies", "texts")),
    "greedy_chunks_of_parts": _of_parts(f"WITH {HEADS}, " + GREEDY.replace("PER_CHUNK", "10")).replace("WITH ", "WITH RECURSIVE ", 1),
    "chunks_of_parts": _of_parts(f"WITH {HEADS}, " + CHUNKS.replace("PER_CHUNK", "10")),
    "checklist_of_parts": _of_parts(f"WITH {CHECKS} SELECT * FROM checks").replace("documents d", "whole d").replace(
        "d.doc_id % 3 = 0 AS front_matter", "(SELECT coalesce(m.comune, '') <> '' FROM meta m WHERE m.c = d.doc_id) AS front_matter"
    ),
}
