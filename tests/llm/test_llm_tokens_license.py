import pytest
import random

from llm_data import EDGE_TEXTS, alnum_words, docs_df

from feedloom.llm import license_scan as S
from feedloom.llm import token_counts as T


def greedy(word, initial, continuing, bare):
    pieces, at, begin = 0, 0, True
    while at < len(word):
        options = [p for p in (initial if begin else continuing) if p and word.startswith(p, at)]
        if not options:
            if begin and bare:
                begin, pieces = False, pieces + 1
                continue
            return 0
        at, begin, pieces = at + max(map(len, options)), False, pieces + 1
    return pieces


def test_automaton_against_greedy():
    rng = random.Random(1)
    for _ in range(40):
        letters = b"abc"[:rng.randrange(1, 4)]
        make = lambda n: {bytes(rng.choice(letters) for _ in range(rng.randrange(1, 6))) for _ in range(n)}
        initial, continuing, bare = make(6), make(6), rng.random() < 0.5
        machine = T.PieceAutomaton(initial, continuing, bare)
        words = [bytes(rng.choice(letters) for _ in range(rng.randrange(1, 12))) for _ in range(60)]
        w = T.W.split([b" ".join(words)], T._TABLE)
        assert machine.count(w.buf, w.starts, w.lens).tolist() == [greedy(x, initial, continuing, bare) for x in words]


def test_counts(spark):
    initial, continuing = [b"the", b"th", b"w", b"one", b"t"], [b"e", b"wo", b"0", b"1", b"2", b"3", b"4", b"5", b"6", b"7", b"8", b"9"]
    got = {r["text_id"]: r for r in T.count_tokens(docs_df(spark, EDGE_TEXTS).withColumnRenamed("doc_id", "text_id"), T.PieceAutomaton(initial, continuing), id_col="text_id")
           .withColumnRenamed("doc_id", "text_id").collect()}
    for i, t in EDGE_TEXTS:
        words = (t or "").encode().split()
        count = [greedy(w, initial, continuing, False) for w in words]
        r = got[i]
        assert (r["n_words"], r["n_tokens"], r["n_unknown"]) == (len(words), sum(c or 1 for c in count), count.count(0))
    assert T.count_tokens(docs_df(spark, []), T.PieceAutomaton(initial, continuing)).collect() == []


def test_templates():
    machine = S.TemplateAutomaton([("x", "licensed under <<opt>>the<</opt>> big <<var 2>> license <<opt>>version 2<</opt>>")])

    def match(text):
        w = S.W.split([text.encode()], S.W.ALNUM_WORDS)
        found, score = machine.match(S.W.find(machine.hashes, S.W.hash_words(w)) + 1)
        return [(a, b) for _, a, b in found], score

    assert match("Licensed under the big license") == ([(0, 5)], 1.0)
    assert match("it is licensed under big, new license, version 2!") == ([(2, 9)], 1.0)
    assert match("licensed under big one two three license")[0] == []
    assert match("licensed under a big license")[0] == []
    assert 0 < match("licensed under the big one")[1] < 1
    assert match("") == ([], 0.0)


def test_scan(spark):
    rows = [*EDGE_TEXTS, (20, "Licensed under CC BY-NC 4.0."), (21, "This work is licensed under the GNU General Public License, version 3."),
            (22, "All rights reserved. all RIGHTS reserved"), (23, "Released under the MIT License."), (24, "general public"), (25, "license all rights"),
            (26, "reserved. Copyright (c) 2020 Some Body. All rights reserved.")]
    got = {r["doc_id"]: r for r in S.scan(docs_df(spark, rows)).collect()}
    for i, t in rows:
        w = alnum_words(t)
        want = sorted((label, k) for p, label in S.BASE_PHRASES.items() for k in range(len(w)) if w[k:k + len(p.split())] == [x.encode() for x in p.split()])
        assert got[i]["n_words"] == len(w) and sorted((p["label"], p["first"]) for p in got[i]["places"]) == want
    labels = {i: {m["label"] for m in got[i]["matches"]} for i in got}
    assert labels[20] == {"cc-by-nc-4.0"} and labels[21] == {"gpl-3.0"} and labels[23] == {"mit"} and "copyright" in labels[26]
    assert labels[24] == labels[25] == set() and got[23]["score"] == 1.0
    assert S.scan(docs_df(spark, [])).collect() == []


def plain_match(template, words):
    """(first, end) of a template at every place, by trying all readings."""
    tokens = S.re.findall(r"<<.*?>>|[^\s<>]+", template)

    def closing(t):
        depth = 0
        for j in range(t, len(tokens)):
            depth += (tokens[j] == "<<opt>>") - (tokens[j] == "<</opt>>")
            if depth == 0:
                return j

    def ends(t, at):
        if t == len(tokens):
            return {at}
        token = tokens[t]
        if token == "<<opt>>":
            return ends(t + 1, at) | ends(closing(t) + 1, at)
        if token == "<</opt>>":
            return ends(t + 1, at)
        if token == "<<any>>":
            for skip in range(len(words) - at + 1):       # the region ends as soon as it can
                if got := ends(t + 1, at + skip):
                    return got
            return set()
        return ends(t + 1, at + 1) if at < len(words) and words[at] == token else set()
    return [(a, max(e)) for a in range(len(words)) if (e := ends(0, a))]


def test_regions_against_plain():
    rng = random.Random(12)
    templates = ["a <<any>> b", "a <<opt>>c<</opt>> <<any>> b b <<opt>>d<</opt>>", "a b <<any>> c <<any>> d", "c <<opt>>a <<opt>>b<</opt>><</opt>> d", "b <<any>> a <<opt>>c d<</opt>>"]
    for template in templates:
        machine = S.TemplateAutomaton([("x", template)])
        for _ in range(150):
            words = [rng.choice("abcdz") for _ in range(rng.randrange(14))]
            w = S.W.split([" ".join(words).encode()], S.W.ALNUM_WORDS)
            found, _ = machine.match(S.W.find(machine.hashes, S.W.hash_words(w)) + 1)
            assert sorted((a, b) for _, a, b in found) == plain_match(template, words), (template, words)


def test_region_bounds_and_many_beginnings():
    import time

    machine = S.TemplateAutomaton(S.TEMPLATES)

    def labels(text):
        w = S.W.split([text.encode()], S.W.ALNUM_WORDS)
        return sorted({machine.labels[k] for k, _, _ in machine.match(S.W.find(machine.hashes, S.W.hash_words(w)) + 1)[0]})
    holders = " ".join(f"Holder{i}" for i in range(900))
    assert labels(f"Copyright (c) {holders}. All rights reserved") == ["copyright", "reserved"]
    assert labels(f"Copyright (c) {holders} {holders}. All rights reserved") == ["reserved"]
    start = time.perf_counter()
    assert labels("Copyright by some one. " * 40_000 + "All rights reserved") == ["copyright", "reserved"]
    assert time.perf_counter() - start < 20
    with pytest.raises(ValueError, match="no mandatory wording"):
        S.TemplateAutomaton([("x", "<<opt>>a<</opt>> <<any>>")])


def test_whole_license_texts():
    machine = S.TemplateAutomaton(S.TEMPLATES)

    def labels(text):
        w = S.W.split([text.encode()], S.W.ALNUM_WORDS)
        return {machine.labels[k] for k, _, _ in machine.match(S.W.find(machine.hashes, S.W.hash_words(w)) + 1)[0]}
    for label in ("mit-text", "isc", "bsd-2-clause", "bsd-3-clause", "apache-2.0-notice"):
        wording = next(t for x, t in reversed(S.TEMPLATES) if x == label)
        text = "Copyright (c) 2020, A. Holder\n" + wording.replace("<<opt>>", "").replace("<</opt>>", "").replace("<<any>>", "the regents of a university").upper()
        assert label in labels(text)
        words = text.split()
        words[len(words) - 3] = "other"                     # mandatory wording must stand exactly
        assert label not in labels(" ".join(words))
