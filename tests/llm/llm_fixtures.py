"""Small documents with every odd case, and brute-force versions of the operators."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, size int, n int, gram int, shard int, bucket int"
WORDS = "ab cde fgh i jkl mno pq rst uvw xyz über straße año 中文 zz yy".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))


def documents(seed=1, rows=60):
    """Texts with copies, near copies, shared passages, nulls, blanks and one long document."""
    rng, out = random.Random(seed), []
    passage = prose(rng, 24)
    for i in range(rows):
        kind = rng.randrange(8)
        if kind == 0 and out:
            text = rng.choice(out)
        elif kind == 1 and out and any(out):
            words = (rng.choice([t for t in out if t])).split()
            words[rng.randrange(len(words)) if words else 0:1] = ["new"]
            text = " ".join(words)
        elif kind == 2:
            text = prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 10)
        elif kind == 3:
            text = rng.choice(["", " \n\t ", None, "one", "One\ttwo three", "a\x0bb\x0c c\x1cd"])
        else:
            text = prose(rng, rng.randrange(1, 120))
        out.append(text)
    out += [out[4], prose(rng, 6000), "he " * 400, passage, None]
    ids = list(range(10, 10 + len(out)))
    ids[-1] = None
    rows = [(i, t, "en", rng.choice(["s1", "s2", None, "ü"]), None, "x", 1, 2, 3, 4, 5) for i, t in zip(ids, out)]
    return rows + [rows[3], rows[3]]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


def gram_set(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def components(rows, k, percent):
    sets = [(r[0], gram_set(r[1], k)) for r in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, a) in enumerate(sets):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((d, len(a), least.get(root(i)) if a else d) for i, (d, a) in enumerate(sets)), key=str)


def cut_repeats(rows, width=50):
    """(doc, bytes, removed, runs, rest) by looking every window up in all smaller documents."""
    big = 1 << 62
    first = {}
    for doc, text in ((r[0], r[1]) for r in rows):
        data, doc = (text or "").encode(), big if doc is None else doc
        for p in range(len(data) - width + 1):
            w = data[p : p + width]
            first[w] = min(first.get(w, big), doc)
    out = []
    for doc, text in ((r[0], r[1]) for r in rows):
        data, mine = (text or "").encode(), big if doc is None else doc
        gone = [False] * len(data)
        for p in range(len(data) - width + 1):
            if first[data[p : p + width]] < mine:
                gone[p : p + width] = [True] * width
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((mine, len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=str)


def thue_morse(letters, power=10):
    """A word of 2^power letters; with the letters swapped, its polynomial hash modulo 2^64 is the same."""
    return "".join(letters[bin(i).count("1") % 2] for i in range(1 << power))
