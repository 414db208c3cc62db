import random
import re

from pyspark.sql import functions as F

from docloom.llm import lines
from tests.llm.helpers import documents, words_of


def words_in(line):
    return frozenset(w for w in re.split("[ \t\r\x0b\x0c]", line.lower()) if w)


def brute(rows):
    """Places of lines that an earlier line matches; rows of (id, text)."""
    every = [(i, n, words_in(line)) for i, text in rows if text is not None for n, line in enumerate(text.split("\n"))]
    every = sorted((e for e in every if len(e[2]) >= lines.LEAST), key=lambda e: (e[0] is not None, e[0] or 0, e[1]))
    gone = set()
    for k, (i, n, own) in enumerate(every):
        for j, m, other in every[:k]:
            if (i, n) != (j, m) and 100 * len(own & other) >= lines.PERCENT * len(own | other):
                gone.add((i, n))
                break
    return gone


def check(spark, rows):
    frame = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    got = lines.dedup(frame).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    seen = {(r["doc_id"], n) for r in got for n in r["_gone"] or []}
    assert seen == want
    left = sorted((str(r["doc_id"]), str(r["text"])) for r in got)
    assert left == sorted((str(i), str(None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in want))) for i, t in rows)
    assert all(r["lang"] == "en" for r in got)


def test_equals_brute_force(spark):
    r = random.Random(4)
    rows = []
    for d in range(60):
        own = []
        for _ in range(r.randrange(6)):
            base = words_of(r.randrange(12), r.choice([3, 6, 15, 40]))
            for _ in range(r.choice([0, 0, 1, 3])):
                base[r.randrange(len(base))] = "Changed"
            own.append(r.choice([" ", "  ", "\t"]).join(base) if r.random() < 0.9 else "")
        rows.append((d, "\n".join(own)))
    check(spark, rows)


def test_defined_cases(spark):
    line = "one two three four five six"
    check(spark, [(3, line), (1, f"{line}\n{line}\nshort one"), (2, None), (4, ""), (None, "seven eight nine ten eleven"), (9, "seven eight nine ten eleven"), (5, "\n\n"), (6, line.upper()), (7, "a b c d"), (8, "a b c d")])


def test_repeated_rows_stand_together(spark):
    line = "one two three four five six"
    check(spark, [(1, line), (1, line), (2, line)])


def test_many_copies_and_long_text(spark):
    text = "\n".join(" ".join(words_of(k, 9)) for k in range(3000))
    check(spark, [(i, " ".join(words_of(500 + i % 2, 12))) for i in range(300)])
    assert lines.dedup(documents(spark, [text])).first()["_lines"] == 3000


def test_empty_table(spark):
    assert lines.dedup(documents(spark, [])).count() == 0


def test_short_lines_and_scripts_without_spaces(spark):
    """Repeated lines of one to four words go, near ones of four and five too; blank lines stay."""
    rows = [(1, "yes\n\n \nread more\nthree of them\n文字文字文字"), (2, "YES\nmore read\n\n \n文字文字文字\nthree of\nno no"), (3, "no\nfour words are here\nx x x x"), (4, "four words are here too\nx\nthree of them all")]
    got = {r["doc_id"]: r["_gone"] for r in lines.dedup(documents(spark, [t for _, t in rows], [i for i, _ in rows])).collect()}
    assert got == {1: None, 2: [0, 1, 4], 3: [0], 4: [0, 1]}
    check(spark, rows)


def test_short_lines_equal_brute_force(spark):
    r = random.Random(9)
    check(spark, [(d, "\n".join(" ".join(r.choice("abcdefgh") for _ in range(r.randrange(7))) for _ in range(6))) for d in range(40)])


def test_columns_of_any_name_are_kept(spark):
    rows = [(1, "one two three four five six\nother"), (2, "one two three four five six"), (None, None)]
    frame = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    names = ["_n", "_map", "_hit", "_hit_", "_bits", "_doc", "_places", "row", "number", "entry", "keys", "a.b"]
    for name in names:
        frame = frame.withColumn(name, F.lit(name))
    got = lines.dedup(frame.withColumn("_gone", F.lit("x")), ("_lines", "cut", "_gone")).collect()
    assert len(got) == 3 and all(r[name] == name for r in got for name in names)
    assert {r["doc_id"]: r["cut"] for r in got} == {1: 0, 2: 1, None: 0}
    assert [r["_gone"] for r in got if r["doc_id"] == 2] == [[0]]


def near_lines(r, words):
    """Documents of lines of 4 to 130 words over few words, some with a few words lost, gained or changed."""
    rows = []
    for d in range(70):
        own = []
        for _ in range(3):
            size = r.choice([4, 5, 8, 9, 10, 11, 12, 13, 30, 60, 130])
            base = [f"w{k}" for k in random.Random(r.randrange(9) * 1000 + size).sample(range(words), size)]
            for _ in range(r.randrange(1 + size // 8)):
                base.pop(r.randrange(len(base)))
            own.append(" ".join([*base, *(f"w{r.randrange(words)}" for _ in range(r.randrange(1 + size // 8)))]))
        rows.append((d, "\n".join(own)))
    return rows


def test_grams_of_three_words(spark, monkeypatch):
    """However many grams take a third word, no pair is lost."""
    for seed, chance in ((1, 0), (3, 0.2)):
        monkeypatch.setattr(lines, "CHANCE", chance)
        check(spark, near_lines(random.Random(seed), 300))


def test_parts_of_the_grams(spark, monkeypatch):
    """Joined in parts, the grams give the same lines, and what earlier steps shuffled and wrote is off the disk."""
    monkeypatch.setattr(lines, "PASS_ROWS", 500)
    parts = []
    monkeypatch.setattr(lines, "release_shuffles", lambda s: parts.append(s))
    check(spark, near_lines(random.Random(5), 200))
    assert len(parts) == 4 + lines.PASSES + 1


def test_chance_meetings_are_no_candidates(spark, monkeypatch):
    """Entries that only share a gram are told apart before their words are fetched."""
    r, seen = random.Random(6), []
    rows = [(d, " ".join(["the", "and", *(f"x{r.randrange(100_000)}" for _ in range(size))])) for d, size in enumerate([12, 20, 40, 60, 120] * 30)]
    real = lines._verified
    monkeypatch.setattr(lines, "_verified", lambda pairs, *a: seen.append(pairs.count()) or real(pairs, *a))
    monkeypatch.setattr(lines, "BUCKETS", 1)
    check(spark, rows)
    assert seen == [0, 0]


def test_same_place_twice(spark):
    """Lines of rows of one doc_id at one place do not match each other; either of them matches later ones."""
    line = "one two three four five six seven"
    check(spark, [(1, line), (1, f"{line} eight"), (2, f"{line} nine"), (None, "a b c d e f"), (None, "a b c d e f g")])


def test_group_of_near_copies(spark):
    r = random.Random(9)
    base = words_of(1, 40)
    rows = []
    for d in range(150):
        own = list(base)
        for _ in range(r.randrange(9)):
            own[r.randrange(40)] = f"w{r.randrange(400)}"
        rows.append((d, " ".join(own)))
    check(spark, rows)
