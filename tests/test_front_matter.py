"""Front matter that is more than flat pairs."""

from __future__ import annotations

import random

import pytest

from docframe.functions import frontmatter as fm
from docframe.operators import assemble

BLOCK = """titolo: piano delle regole
  dei servizi: parte
tags:
  - uno
  - due: tre
    quattro: 5
  - - x
    - y
note: |
  riga uno
  riga: due

    rientrata
sede:
  via: 'Roma, 1'
  cap: "00123"
  altro: {a: 1, b: [x, "y, z", null]}
lista: [a, b,
  c]   # commento
piega: >-
  una
  due

  tre
vuota:
comune: 'l''Aquila'
chiave:senza
"""
WANT = {
    "titolo": "piano delle regole dei servizi: parte",
    "tags": ["uno", {"due": "tre", "quattro": "5"}, ["x", "y"]],
    "note": "riga uno\nriga: due\n\n  rientrata\n",
    "sede": {"via": "Roma, 1", "cap": "00123", "altro": {"a": "1", "b": ["x", "y, z", None]}},
    "lista": ["a", "b", "c"],
    "piega": "una due\ntre",
    "vuota": None,
    "comune": "l'Aquila",
    "chiave": "senza",
}


def written(tree):
    return "\n".join(f"{k}:{fm.shown(v)}" for k, v in sorted(tree.items()))


def test_lists_maps_and_long_texts_are_read():
    assert {k: fm.plain(v) for k, v in fm.parsed(BLOCK).items()} == WANT


def test_what_is_written_is_read_again():
    tree = fm.parsed(BLOCK)
    assert fm.plain(fm.parsed(written(tree))) == WANT and written(fm.parsed(written(tree))) == written(tree)


@pytest.mark.parametrize("block", ["", "\n\n", "- a\n- b", "solo testo", "a: [1, {b", "a: 'x", 'a: "\\q', "a: |", "a:\n\t- b", "- : x", "{a: 1}", "a: *x", "?", ":", "a: {", "a: ]", "[", "a: [,,]", "a: {:}", "a:\n  - b\n c: d"])
def test_any_text_can_be_read(block):
    assert isinstance(fm.parsed(block), dict)
    fm.leaves(fm.parsed(block))


TEXTS = ["x", "uno due", "a: b", "- c", "12", "0012", "true", "no", "", "riga\ndue", "riga\n\n  due\n", "  lead\nx", "# no", "a #b", "it's", "'q'", '"dq"', "tab\there", "[x]", "{y", "a,b", "*z", "&z", "`r", "x:", "é: à", "1.5", "~", "a\n", "a\n\n", "\n", "x ", "? y", "| z", "-"]


def made(rng, depth):
    r = rng.random()
    if depth and r < 0.3:
        return {rng.choice(["a", "c d", "è", "k-1", "it's"]) + str(k): made(rng, depth - 1) for k in range(rng.randint(0, 3))}
    if depth and r < 0.55:
        return [made(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return None if r < 0.6 else rng.choice(TEXTS)


def texts(tree):
    if isinstance(tree, dict):
        return {k: texts(v) for k, v in tree.items()}
    return [texts(v) for v in tree] if isinstance(tree, list) else None if tree is None else fm.Text(tree, True)


def test_round_trips_of_random_trees():
    rng = random.Random(4)
    for _ in range(3000):
        tree = {f"k{j}": made(rng, 3) for j in range(rng.randint(1, 4))}
        assert fm.plain(fm.parsed(written(texts(tree)))) == tree


def test_documents_keep_their_front_matter(spark):
    page = f"---\n{BLOCK}---\n\n# Titolo\n\ntesto"
    df = spark.createDataFrame([(1, "a.pdf", 1, page), (2, "b.pdf", 1, "---\n- a\n---\n\ntesto"), (3, "c.pdf", 1, None)], "doc_id long, source_file string, page_number int, page_md string")
    docs = assemble.md_documents(df)
    got = {}
    for r in assemble.front_matter_values(docs).collect():
        got.setdefault(r.doc_id, {})[r.path] = r.value
    assert got[1] == dict(fm.leaves(fm.parsed(BLOCK))) | {"tipo": "UNKNOWN", "anno": "UNKNOWN"}
    assert got[2] == {"titolo": "b", "comune": "UNKNOWN", "tipo": "UNKNOWN", "anno": "UNKNOWN"}
    meta = {r.doc_id: r.given for r in assemble.document_metadata(df).collect()}
    assert meta[1]["lista"] == '["a", "b", "c"]' and meta[1]["vuota"] is None
