from __future__ import annotations

from pyspark.sql import functions as F

from docframe.operators import headings, quality, segments


def segs(df):
    out = {}
    for r in segments.segments(df).orderBy("doc_id", "tuid").collect():
        out.setdefault(r.doc_id, []).append(r.segment)
        assert r.tuid == len(out[r.doc_id])
    return out


def test_segments_of_a_document(docs):
    md = (
        "---\ntitolo: x\n---\n# Title *one*\n\nfirst line\nsecond **line**\n- item\n"
        "<!-- note\nover lines -->\n| A | **B** |  |\n|---|---|---|\n| 1 | | 2 |\ntail\n##\n####### seven\n"
    )
    assert segs(docs(md))[0] == [
        "Title one",
        "first line second line - item",
        "A | B",
        "1 | 2",
        "tail ## ####### seven",
    ]


def test_segments_edge_cases(docs):
    got = segs(docs("", "---\na: b\n---\n", "| | |\n", "a\r\nb c", "| _a | b_ |", "# \n* *"))
    assert got == {3: ["a b c"], 4: ["_a | b_"], 5: ["#"]}


def test_table_row_cells_are_cleaned_once(docs):
    # the pipe between the cells must not let an underscore pair form
    assert segs(docs("| _a | `x` | b_ |"))[0] == ["_a | x | b_"]


def test_tmx_escapes_and_skips_empty_documents(docs):
    rows = segments.tmx_documents(docs("a < b & \"c\"", "\n"), "it", "en", "20250101T000000Z").collect()
    assert [r.doc_id for r in rows] == [0]
    assert '<seg>a &lt; b &amp; "c"</seg>' in rows[0].tmx
    assert rows[0].tmx.endswith("    </tu>\n  </body>\n</tmx>\n")


def test_heading_skips(docs):
    df = docs("# A\n### B\n##### no\n    # no\n#### C\n## D\n#### E", "### first\n# x", "text")
    got = [(r.doc_id, r.line_no, r.previous_level, r.level) for r in headings.heading_skips(df).collect()]
    assert sorted(got) == [(0, 2, 1, 3), (0, 7, 2, 4)]
    message = headings.heading_skips(df).filter("line_no = 2").first().message
    assert message == "Line 2: heading level skips from 1 to 3 — '### B'"


def test_fix_heading_skips_and_fixpoint(docs):
    df = docs("# A\n### B\ntext\n", "# A\n#### B", "no heading", "", "x\n\n## A\n#### B\n")
    once = headings.fix_heading_skips(df)
    got = {r.doc_id: r.md for r in once.collect()}
    assert got == {
        0: "# A\n## (continued)\n### B\ntext",
        1: "# A\n#### B",
        2: "no heading",
        3: "",
        4: "x\n\n## A\n### (continued)\n#### B",
    }
    assert {r.doc_id: r.md for r in headings.fix_heading_skips(once).collect()} == got


def test_sections_have_paths(docs):
    rows = headings.sections(docs("intro\n# T\na\n## B\n### C\nb\n## D\nc")).orderBy("section_no").collect()
    assert [(r.path, r.first_line, r.last_line, r.body) for r in rows] == [
        ("T", 2, 3, "a"),
        ("T > B", 4, 4, ""),
        ("T > B > C", 5, 6, "b"),
        ("T > D", 7, 8, "c"),
    ]


def test_chunks_cover_the_document(docs):
    md = "\n".join(f"## H{i}\nx\ny" for i in range(50))
    rows = headings.chunks(docs(md, "one line"), lines_per_chunk=10).orderBy("doc_id", "chunk_no").collect()
    mine = [r for r in rows if r.doc_id == 0]
    assert "\n".join(r.text for r in mine) == md
    assert all(r.text.startswith("## ") for r in mine)
    assert [(r.first_line, r.last_line) for r in rows if r.doc_id == 1] == [(1, 1)]


def test_checklist(docs):
    good = "---\ntitolo: a b\n  c: d\ncomune: x\ntipo: y\nanno: 1\n---\n# T\n## A\n| a | b |\n|---|---|\n| 1 | 2 |\n![i](img/a.png)"
    bad = "# T\n# U\n### A\n| a | b |\n| 1 |\n![i](http://x/a.png)\n<!-- UNREADABLE: page 3 -->"
    rows = quality.quality_checklist(docs(good, bad)).orderBy("doc_id").collect()
    assert tuple(rows[0])[1:] == (True, True, True, True, True, [])
    assert tuple(rows[1])[1:] == (False, False, False, False, False, [3])


PIECES = ["---\ntitolo: x\n---\n# A\n\none\n| a |\n|---|", "\n\nmore **text**\nof it\n### C\n| b |", "\n\nlast\n\n#### D\n\nx", "\n\n# E\ntail\n"]


def cut(spark):
    rows = [(7, p, t) for p, t in enumerate(PIECES)] + [(8, 0, "# only\n")]
    return spark.createDataFrame(rows, "doc_id long, part_no int, md string")


def whole(spark):
    return spark.createDataFrame([(7, "".join(PIECES)), (8, "# only\n")], "doc_id long, md string")


def test_parts_are_read_like_whole_documents(spark):
    same = lambda fn: (sorted(map(tuple, fn(cut(spark)).collect())), sorted(map(tuple, fn(whole(spark)).collect())))
    for fn in (segments.segments, segments.table_row_segments, headings.heading_skips, quality.quality_checklist):
        parts, one = same(fn)
        assert parts == one and one
    assert quality.line_diff(cut(spark), whole(spark)).count() == 0
    for fn, text in ((lambda d: segments.tmx_documents(d, "it", "en", "20250101T000000Z"), "tmx"), (headings.fix_heading_skips, "md")):
        parts = {}
        for r in fn(cut(spark)).orderBy("part_no").collect():
            parts[r.doc_id] = parts.get(r.doc_id, "") + r[text]
        assert parts == {r.doc_id: r[text] for r in fn(whole(spark)).collect()}


def test_sections_and_chunks_go_on_in_later_parts(spark):
    for fn, no, text in ((headings.sections, "section_no", "body"), (lambda d: headings.chunks(d, lines_per_chunk=6), "chunk_no", "text")):
        rows = {}
        for r in fn(cut(spark)).orderBy("piece_no").collect():
            rows.setdefault((r.doc_id, r[no]), []).append(r)
        one = {(r.doc_id, r[no]): r for r in fn(whole(spark)).collect()}
        assert set(rows) == set(one)
        for key, pieces in rows.items():
            assert "\n".join(p[text] for p in pieces) == one[key][text]
            assert (pieces[0].first_line, pieces[-1].last_line) == (one[key].first_line, one[key].last_line)
            if no == "section_no":
                assert all((p.title, p.path, p.level) == (one[key].title, one[key].path, one[key].level) for p in pieces)


def test_line_diff_counts_copies(docs):
    left, right = docs("a\na\nb"), docs("a\nb\nc")
    got = {(r.line, r.n_left, r.n_right) for r in quality.line_diff(left, right).collect()}
    assert got == {("a", 2, 1), ("c", 0, 1)}


def test_glued_words_against_brute_force(spark):
    texts = ["superficie territoriale"] * 5 + ["superficieterritoriale"] + ["super", "ficie"] * 6
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    freq = {}
    for t in texts:
        for w in set(t.split()):
            freq[w] = freq.get(w, 0) + 1
    want = {}
    for w, n in freq.items():
        cuts = [
            (min(freq.get(w[:p], 0), freq.get(w[p:], 0)), -p)
            for p in range(2, len(w) - 1)
            if freq.get(w[:p], 0) >= 5 and freq.get(w[p:], 0) >= 5
        ]
        if n < 5 and cuts:
            want[w] = -max(cuts)[1]
    cuts = quality.split_glued_words(df)
    assert {r.word: len(r.first) for r in cuts.collect()} == want
    mended = quality.repair_glued_words(df, cuts).select(F.col("line")).collect()
    assert [r.line for r in mended] == ["superficie territoriale"]
