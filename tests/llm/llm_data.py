"""Small inputs and plain reference versions for the operator tests."""
import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977} the of" for i in range(12_000))

EDGE_TEXTS = [
    (1, None), (2, ""), (3, " \t\n  "), (4, "one two"), (5, LONG), (6, "the same words stand here twice or more often than that"),
    (7, "the same words stand here twice or more often than that"), (7, "the same words stand here twice or more often than that"),
    (None, "a text without an id but with some words in it"), (9, "1234 5678 .,;"), (10, "ÉCOLE Über große ñandú"), (11, "x" * 5000),
]


def docs_df(spark, rows, extra=()):
    """Documents with columns of clashing names beside the usual ones."""
    clash = ["key", "node", "n", "token", "items", "spans", "score", "row", "part", "size", "before", "total", "shard", "slot", "rank", "vector", *extra]
    schema = DOC_SCHEMA + "".join(f", {c} string" for c in clash)
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None, *["clash"] * len(clash)) for i, t in rows], schema)


def space_words(text):
    return (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()


def alnum_words(text):
    raw = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))
    return bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in raw).split()


def near_copies(seed=3, groups=12, size=6, words=60):
    """Random texts with near copies of growing distance, short ones too."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    rows = []
    for g in range(groups):
        n = rng.choice([3, 5, 8, 9, 10, 12, 14, 30, words, 3 * words])
        base = [rng.choice(vocabulary) for _ in range(n)]
        rows.append(" ".join(base))
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(copy) + 1)
                if rng.random() < 0.5:
                    copy.insert(at, rng.choice(vocabulary))
                elif at < len(copy):
                    copy[at] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
    rng.shuffle(rows)
    return list(enumerate(rows))


def shingles(text, k=5):
    w = space_words(text)
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    """Component of every row number: the smallest non-null id reachable."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        if doc_id is not None:
            low[r] = min(low.get(r, doc_id), doc_id)
    return [(doc_id, len(sets[i]), low.get(find(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)]
