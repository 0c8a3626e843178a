"""Encoding, evaluation leakage and template residue."""

import re
from random import Random

import numpy as np
import pytest

from quillwort.llm.bpe import PIECES, VOCABULARY, BytePairEncoder, encode, read_ranks
from quillwort.llm.leakage import PER_EDIT, WindowIndex, edit_distance, leaked_items, words
from quillwort.llm.residue import ERROR_FORMS, FILLER_FORMS, SCRIPT_FORMS, evidence, plain, residue

from tests.llm import fresh, sentences

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(VOCABULARY)


@pytest.fixture(scope="module")
def encoder(ranks):
    return BytePairEncoder(ranks)


def texts():
    rng = Random(4)
    letters = "abcdeghilmnorst"
    out = ["", "a", " ", "it's <|endoftext|>", "naïve café ﬁne", "水" * 700, "=" * 5000, "ab" * 900, "\n" * 300, "\x00\x01", "🙂🙃" * 100, " " * 257 + "x"]
    out += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 300))) for _ in range(200)]
    out += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 1200), rng.randint(0x4E00, 0x9FFF)])) for _ in range(rng.randrange(200))) for _ in range(200)]
    return out


def test_ids_equal_the_public_library(encoder, ranks):
    known = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    ids, at = encoder.encode_batch(texts())
    for i, t in enumerate(texts()):
        assert ids[at[i] : at[i + 1]].tolist() == known.encode_ordinary(t), t[:40]


def test_round_trip(encoder, ranks):
    back = {v: k for k, v in ranks.items()}
    ids, at = encoder.encode_batch(texts())
    for i, t in enumerate(texts()):
        assert b"".join(back[x] for x in ids[at[i] : at[i + 1]].tolist()).decode() == t


def test_cache_bound(ranks, monkeypatch):
    monkeypatch.setattr("quillwort.llm.bpe.CACHED", 50)
    small = BytePairEncoder(ranks)
    for t in texts()[:80]:
        small.encode_batch([t, t])
    known = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    ids, _ = small.encode_batch(["once more"])
    assert ids.tolist() == known.encode_ordinary("once more")


def test_encode_frame(spark, monkeypatch):
    rows = [(1, "hello world"), (2, None), (3, ""), (4, "x" * 300_000), (1, "hello world")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id int, text string, ids int")
    got = sorted((r["doc_id"], len(r["ids"])) for r in encode(df, "doc_id", "text").collect())
    assert [g for g in got if g[0] < 4] == [(1, 2), (1, 2), (2, 0), (3, 0)] and got[-1][0] == 4
    assert encode(df.limit(0), "doc_id", "text").count() == 0


def test_words():
    assert words("Ab-c_d ２３ ﬁx ½ é") == words("ab c d 23 fix 1 2 é")
    assert words(None) == words("") == words(" .,!") == []


def test_edit_distance_equals_the_recursion():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 4, (200, 6)), rng.integers(0, 4, (200, 6))

    def slow(x, y):
        d = np.arange(len(y) + 1)
        for i, p in enumerate(x):
            e = [i + 1]
            for j, q in enumerate(y):
                e.append(min(e[j] + 1, d[j + 1] + 1, d[j] + (p != q)))
            d = e
        return d[-1]

    assert edit_distance(a, b).tolist() == [slow(x, y) for x, y in zip(a.tolist(), b.tolist())]


def corpus(rng):
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 40)))) for i in range(30)]
    docs = []
    for i in range(200):
        parts = [rng.choice([*vocabulary, "foreign"]) for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.5:
            source = words(rng.choice(items)[1])
            at = rng.randrange(max(1, len(source) - 11))
            parts[10:10] = source[at : at + rng.randrange(9, 16)]
        docs.append((i, ", ".join(parts).upper()))
    return docs, items


def windows(text):
    w = words(text)
    return {tuple(w[k : k + 12]) for k in range(len(w) - 11)}


@pytest.mark.parametrize("indexed", [1_000_000, 100])
def test_leaks_equal_brute_force(spark, monkeypatch, indexed):
    monkeypatch.setattr("quillwort.llm.leakage.INDEXED", indexed)
    docs, items = corpus(Random(1))
    docs += [(900, None), (901, ""), (902, "short"), (903, "pad " * 50_000 + items[3][1] + " pad" * 50_000)]
    want = {(d, i) for d, t in docs for i, s in items if windows(t) & windows(s)}
    assert want
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    ev = spark.createDataFrame([(*i, 1) for i in [*items, items[0], (99, None)]], "item_id long, text string, doc_id int")
    for edits in (0, 2):
        assert {(r[0], r[1]) for r in leaked_items(df, ev, max_edits=edits).collect() if not r["edits"]} == want
    assert leaked_items(df.limit(0), ev).count() == 0 and leaked_items(df, ev.limit(0)).count() == 0


@pytest.mark.parametrize("edits", [1, 2])
def test_recall_with_edits(edits):
    rng = Random(7)
    items = [(i, [f"w{rng.randrange(300)}" for _ in range(30)]) for i in range(60)]
    index = WindowIndex(items, edits, PER_EDIT * edits, 8, 42)
    hits = total = 0
    for _ in range(600):
        window = index.windows[rng.randrange(len(index.windows))].tolist()
        changed = [*window, 0, 0]
        for _ in range(edits):
            at, kind = rng.randrange(12), rng.randrange(3)
            if kind == 0:
                changed[at] = 0
            elif kind == 1:
                changed.insert(at, 0)
            else:
                del changed[at]
        changed = np.array(changed[:12], np.int32)
        if edit_distance(changed[None], np.array([window]))[0] <= edits:
            total += 1
            hits += len(index.search(changed, np.zeros(12, int))[0]) > 0
            assert len(index.search(changed, np.zeros(12, int), exact=True)[0])
    assert total > 100 and hits / total >= 0.95


def edited(rng, ws, vocabulary):
    out = list(ws)
    for _ in range(rng.randrange(0, 4)):
        at = rng.randrange(len(out))
        out[at : at + rng.randrange(2)] = [rng.choice(vocabulary)] * rng.randrange(2)
    return out


def test_edits_on_documents_against_all_pairs(spark):
    rng = Random(3)
    vocabulary = [f"v{i}" for i in range(80)] + ["foreign"]
    items = [(i, " ".join(rng.choice(vocabulary[:-1]) for _ in range(20))) for i in range(30)]
    docs = []
    for i in range(150):
        parts = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 30))]
        parts[5:5] = edited(rng, words(rng.choice(items)[1])[:14], vocabulary)
        docs.append((i, " ".join(parts)))
    want = {}
    for d, t in docs:
        for i, s in items:
            a, b = sorted(windows(t)), sorted(windows(s))
            if a and b:
                code = {w: n for n, w in enumerate({w for x in a + b for w in x})}
                aa, bb = np.array([[code[w] for w in x] for x in a]), np.array([[code[w] for w in x] for x in b])
                least = edit_distance(np.repeat(aa, len(bb), 0), np.tile(bb, (len(aa), 1))).min()
                if least <= 2:
                    want[d, i] = least
    df, ev = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r[0], r[1]): r[2] for r in leaked_items(df, ev, exact=True).collect()} == want
    got = {(r[0], r[1]): r[2] for r in leaked_items(df, ev).collect()}
    assert set(got) <= set(want) and {k for k, v in want.items() if v == 0} == {k for k, v in got.items() if v == 0}
    for edits in (1, 2):
        true = [k for k, v in want.items() if v == edits]
        assert len(true) > 15 and sum(k in got for k in true) / len(true) >= 0.95


FOUND = [
    ("We saw {{COUNT}} boxes.", "field"), ("Dear [INSERT NAME], hello", "field"), ("a <%= date %> b", "field"), ("at <site_name> and", "field"), ("on &lt;date&gt; we", "field"), ("was ???TIME???", "field"), ("[your site] is", "field"), ("[Anzahl here]", "field"),
    ("Lorem ipsum dolor sit amet.", "filler"), ("xxxx xxx xxxx xxxx", "filler"), ("Your text goes here.", "filler"), ("BLINDTEXT, BITTE ERSETZEN.", "filler"), ("Texte provisoire, à remplacer.", "filler"), ("blah blah blah", "filler"),
    ("HTTP 502 Bad Gateway", "error"), ("404 Not Found", "error"), ("Your session has expired. Sign in again to continue.", "error"), ("La página solicitada no existe.", "error"), ("Die Sitzung ist abgelaufen.", "error"), ("Access denied", "error"),
    ("Please enable JavaScript to view this page.", "script"), ("Bitte aktivieren Sie JavaScript.", "script"), ("Your browser is not supported.", "script"), ("Veuillez activer JavaScript pour afficher la carte.", "script"), ("Aktifkan JavaScript untuk melihat peta.", "script"),
]
CLEAN = [
    None, "", "   ", "start", "a" * 5000, "404", "The list writer replaces `{{stem}}` with the stem.", 'Template fields such as "[INSERT SITE]" were all filled in.', 'Someone had written "lorem ipsum" on the slate.', "Buoy 404 was not found on the old chart, so crew A22 sounded.",
    "Access to the lake was denied by the lock keeper at 19:40.", "The script is required reading for new annotators.", "Class ids are written as {0: litter, 1: hyacinth}.", "```\n{{x}}\n<%= y %>\n```", "Use `${ROOT}/labels`.", "[weir_cam] rows=3", "- [x] done", "<p>text</p> <br>",
    'The portal answered "502 Bad Gateway" twice on 2022-05-16.', "The tablet map needs JavaScript, and since 2022-07-13 it is enabled on all 26 tablets.", "It rose by 4.5% of boxes and 3% of tiles.", '{"check": "orphans", "status": "PASS"}', "<|endoftext|>",
]


@pytest.mark.parametrize(("text", "kind"), FOUND)
def test_evidence(text, kind):
    assert kind in {k for _, k in evidence(text)}
    assert kind in {k for _, k in evidence("A plain line.\n" + text + "\nAnother one.")}


@pytest.mark.parametrize("text", CLEAN)
def test_no_evidence(text):
    assert evidence(text) == []


def found_of(cases):
    return [bool(evidence(s)) for text in cases.values() for s in text.split("\n")]


@pytest.mark.parametrize(("found", "clean", "recall"), [
    ([bool(evidence(s)) for h in (0, 1) for _, _, s in sentences.cases(h)], [s for h in (0, 1) for _, s in sentences.clean(h)], 0.95),
    (found_of(fresh.FRESH_CASES), fresh.FRESH_CLEAN, 0.95),
    (found_of(fresh.LAST_CASES), fresh.LAST_CLEAN, 0.9),  # written after all rules
])
def test_recall_and_precision_on_sentences(found, clean, recall):
    wrong = [s for s in clean if evidence(s)]
    assert sum(found) / len(found) >= recall
    assert sum(found) / (sum(found) + len(wrong)) >= 0.95, wrong


def test_every_form_can_be_reached():
    """A form is only tried if one of its words is there, so each must have words that its matches hold."""
    for words_, form in (*FILLER_FORMS, *SCRIPT_FORMS, *ERROR_FORMS):
        assert all(w == w.lower() and w for w in words_.split("|"))
        hit = [s for c in (sentences.CASES, fresh.FRESH_CASES, fresh.LAST_CASES) for t in c.values() for s in plain(t).split("\n") if re.search(form, s)]
        assert all(any(w in s for w in words_.split("|")) for s in hit), (words_, hit)


def test_many_recurrent_lines_are_joined(spark, monkeypatch):
    rows = [(i, f"Report {chr(97 + i)}.\nAccess denied", "a") for i in range(25)] + [(90, "Access denied", "a"), (91, "```\nAccess denied\n```", "b")]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    want = [(90, "error")]
    assert sorted(map(tuple, residue(df).collect())) == want
    monkeypatch.setattr("quillwort.llm.residue.SENT", 0)
    assert sorted(map(tuple, residue(df).collect())) == want


LATIN = [
    "Aquiter velorum cantare plenitas amentum sednam versum hortica gravidus cantare cantare ripalem hortica fluvendo versum dolit porilis.",
    "# Beldowick / capture plan 82 terrisque nisquam amentum dolit amentum dolit hortica sednam hortica cantare cantare quorbis undavit.",
    "Notes of the lake 7 terrisque interdum tempor dolit amentum incididunt.",
    "terrisque nisquam 3 amentum dolit 4 hortica velorum",
]


@pytest.mark.parametrize("text", LATIN)
def test_make_believe_latin_is_filler(text):
    assert evidence(text) == [(0, "filler")]


@pytest.mark.parametrize("text", ["The versum of 82 is in the plan of the lake.", "Weir 82 terrisque nisquam amentum dolit.", "crew 12 counted 5 plastic bags, 3 paper cups, 9 bottles, 2 tyres, 4 lids"])
def test_few_words_or_other_words_are_no_latin(text):
    assert evidence(text) == []


def test_boilerplate_is_subtracted(spark):
    banner = "Please enable JavaScript for the best experience."
    rows = [(i, f"Report {i} of the day with number {i * 7} and word{chr(97 + i)}.\n{banner}", "a") for i in range(25)]
    rows += [(100, banner, "a"), (101, "Own.\n" + banner, "b"), (102, "Own {{x}} line\n" + banner, "a"), (103, None, "a"), (104, "", None), (105, "Text {{y}}", None), (105, "Text {{y}}", None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id int, text string, source string, line int")
    got = sorted(map(tuple, residue(df).collect()))
    assert got == [(100, "script"), (101, "script"), (102, "field"), (105, "field")]
    assert residue(df.limit(0)).count() == 0


@pytest.mark.parametrize("times", [1, 2])
def test_boilerplate_does_not_depend_on_size(spark, times):
    word = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    rows = [(i, f"Text {word(i)}." + ("\nAccess denied" if i % 40 == 0 else "\nPage not found" if i % 200 == 1 else "")) for i in range(400 * times)]
    df = spark.createDataFrame([(*r, "a") for r in rows], "doc_id int, text string, source string")
    assert sorted(r["doc_id"] for r in residue(df).collect()) == [i for i, _ in rows if i % 200 == 1]


@pytest.mark.parametrize("text", [
    "Your session has expired because no changes were saved.", "This page is no longer available since 2023.", "Because no changes were saved, your session has expired.",
    "Something went wrong because your files were copied twice.",
])
def test_main_clause_of_a_page_is_evidence(text):
    assert [k for _, k in evidence(text)] == ["error"]


@pytest.mark.parametrize("text", [
    "The tablet map needs JavaScript, and since 2022-07-13 it is enabled on all 26 tablets.",
    "The keeper said the page was not found.", "We saw that an error occurred.", "The server answered that the page could not be found.",
])
def test_reports_of_others_are_no_evidence(text):
    assert evidence(text) == []
