"""License scans: alignment against dynamic programming, places and edge cases."""

import random

from quartermill.llm.licenses import TEMPLATES, WORD, common_subsequence, increasing, patience, scan_licenses


def test_longest_increasing_run():
    rng = random.Random(1)
    for _ in range(50):
        b = rng.sample(range(30), 12)
        pairs = list(enumerate(b))
        best = [1] * 12
        for i in range(12):
            best[i] = 1 + max((best[j] for j in range(i) if b[j] < b[i]), default=0)
        got = increasing(pairs)
        assert len(got) == max(best) and [y for _, y in got] == sorted(y for _, y in got)


def test_alignment_is_an_alignment_and_finds_edits():
    rng = random.Random(2)
    for _ in range(100):
        b = [rng.choice("abcdefghijklmnop") for _ in range(30)]
        a = list(b)
        for _ in range(4):
            k = rng.randrange(len(a))
            a[k : k + rng.randint(0, 2)] = [rng.choice("xyzab")] * rng.randint(0, 2)
        got = patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x < u and y < v for (x, y), (u, v) in zip(got, got[1:]))
        assert len(got) <= len(common_subsequence(a, b)) and len(got) >= 0.7 * len(common_subsequence(a, b))


def test_licenses_are_found_where_they_are(spark):
    mit, apache = TEMPLATES["MIT text"], TEMPLATES["Apache-2.0 statement"]
    filler = "der die das été the a of to and " * 300
    edited = mit.replace("free of charge", "at no cost").replace("sublicense, ", "").upper()
    texts = [
        filler + apache + "\n" + filler, edited, apache + " " + filler + apache, None, "", "?!", filler, "licensed under the", mit[: len(mit) // 2],
        "é " + mit.replace(" ", "\n * "), apache[:-1] + " (the License)", "the license " * 3000,
    ]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(0, texts[0], "y")], "n int, text string, LICENSES string").repartition(3)
    got = df.sparkSession.createDataFrame(scan_licenses(df).collect()) if False else scan_licenses(df).collect()
    assert len(got) == len(texts) + 1
    found = {r.n: [(x.name, x.coverage, texts[r.n][x.start : x.stop]) for x in r.licenses] for r in got}
    assert found[0] == [("Apache-2.0 statement", 1.0, apache[:-1])]
    assert [x[0] for x in found[1]] == ["MIT text"] and 0.9 < found[1][0][1] < 1 and found[1][0][2].startswith("PERMISSION") and found[1][0][2].endswith("SOFTWARE")
    assert [x[0] for x in found[2]] == ["Apache-2.0 statement"] * 2
    assert all(found[k] == [] for k in (3, 4, 5, 6, 7, 8, 11))
    assert [(x[0], x[1]) for x in found[9]] == [("MIT text", 1.0)]
    assert [x[0] for x in found[10]] == ["Apache-2.0 statement"]


def test_every_template_finds_itself_alone(spark):
    df = spark.createDataFrame(list(TEMPLATES.items()), "name string, text string")
    for r in scan_licenses(df).collect():
        best = {x.name: x.coverage for x in r.licenses}
        assert best[r.name] == 1.0
        assert set(best) <= {r.name} | {k for k, v in TEMPLATES.items() if len(WORD.findall(v.lower().encode())) < len(WORD.findall(r.text.lower().encode()))}


def test_no_templates_and_empty_tables(spark):
    df = spark.createDataFrame([("a",)], "text string")
    assert [r.licenses for r in scan_licenses(df, templates={}).collect()] == [[]]
    assert [r.licenses for r in scan_licenses(df, templates={"none": "..."}).collect()] == [[]]
    assert scan_licenses(df.limit(0)).collect() == []


def plain_length(a, b):
    """Length of the longest common subsequence, by the book."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def test_subsequences_of_any_size(monkeypatch):
    from quartermill.llm import licenses

    rng = random.Random(5)
    for cells in (1 << 22, 30):
        monkeypatch.setattr(licenses, "CELLS", cells)
        for _ in range(60):
            a, b = ([rng.choice("abcde") for _ in range(rng.randrange(25))] for _ in "ab")
            got = common_subsequence(a, b)
            assert len(got) == plain_length(a, b) and all(a[i] == b[j] for i, j in got)
            assert all(x < u and y < v for (x, y), (u, v) in zip(got, got[1:]))


def test_altered_copies_in_a_row_are_each_found(spark):
    rows, want = [], []
    for k, (name, text) in enumerate(sorted(TEMPLATES.items())):
        words = WORD.findall(text.encode().lower())
        if len(words) < 40:
            continue
        copies = []
        for c in range(3):
            own = [w.decode() for w in words]
            for at in [0, -1, 5 + 3 * c][: 2 + c % 2]:
                own[at] = f"altered{c}"
            copies.append(own)
        rows.append((k, name, " ".join(" ".join(c) for c in copies)))
        want.append((k, [sum(not w.startswith("altered") for w in c) / len(c) for c in copies]))
    got = {r.k: [x.coverage for x in r.licenses if x.name == r.name] for r in scan_licenses(spark.createDataFrame(rows, "k int, name string, text string")).collect()}
    assert got == dict(want)


def test_scan_against_a_plain_search(spark):
    # Every stretch of the text is aligned by the book; the places found must be the copies that reach the coverage.
    rng = random.Random(9)
    template = [f"t{k % 17}" for k in range(30)]
    rows, want = [], []
    for n in range(60):
        text, found = [], []
        for _ in range(rng.randrange(4)):
            text += [rng.choice(["x", "y", "z", "t3"]) for _ in range(rng.randrange(0, 25))]
            copy = list(template)
            for _ in range(rng.choice([0, 1, 3, 12])):
                copy[rng.randrange(len(copy))] = "q"
            found.append((len(text), copy))
            text += copy
        rows.append((n, " ".join(text)))
        want.append([plain_length(c, template) for _, c in found if plain_length(c, template) >= 0.8 * len(template)])
    df = spark.createDataFrame(rows, "n int, text string")
    got = {r.n: [round(x.coverage * 30) for x in r.licenses] for r in scan_licenses(df, templates={"t": " ".join(template)}).collect()}
    for n, lengths in enumerate(want):
        assert len(got[n]) == len(lengths), (n, got[n], lengths)
        assert all(g <= w + 1 and g >= 24 for g, w in zip(got[n], lengths)), (n, got[n], lengths)


def test_a_long_dense_text_is_scanned_in_seconds(spark):
    import time

    rng = random.Random(4)
    words = WORD.findall(TEMPLATES["Apache-2.0 notice"].encode().lower())
    text = " ".join(rng.choice(words).decode() for _ in range(100_000))
    start = time.time()
    assert scan_licenses(spark.createDataFrame([(text,)], "text string")).count() == 1
    assert time.time() - start < 60
