"""Small texts with everything that may go wrong, and words as the operators see them."""

import random
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, row string, k string, digest string, `odd name` int"


def words(text, lower=False):
    raw = (text or "").encode()
    return WORD.findall(raw.lower() if lower else raw)


def texts(seed=1):
    r = random.Random(seed)
    vocabulary = ["the", "of", "and", "Über", "naïve", "x", "été", "é", "run,", "stop.", "#tag", "漢字"] + [f"w{i}" for i in range(300)]

    def prose(n):
        return "".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "\n", "  ", "\t", " "]) for _ in range(n))

    passage = " ".join(r.choice(vocabulary) for _ in range(60))
    base = prose(160)
    out = [None, None, "", " \n\t", "one", "one", "One", "a b c", "a b c d", base, base, base.replace(" ", "  "), base.upper()]
    changed = base.split(" ")
    for i in (5, 30, 55):
        changed[i] = "changed"
        out.append(" ".join(changed))
    out += [prose(r.randint(1, 60)) + passage + " " + prose(r.randint(1, 60)) for _ in range(6)]
    out += ["loop " * 200, "ab " * 90 + prose(50), "no\nno\nno\nyes\n" * 6 + "end", "a" * 3_000, prose(2_000), passage]
    out += ["LINE one\nline two\nline three\nline four\n" + prose(5), "first\nLINE one\nline two\nline three\nline four"]
    out += [prose(r.randint(1, 200)) for _ in range(30)]
    return out


def documents(spark, seed=1, ids=None):
    rows = []
    for i, text in enumerate(texts(seed)):
        doc_id = i * 7 % 101 if ids is None else ids(i)
        rows.append((doc_id, text, [None, "en", "de"][i % 3], [None, "b", "a", "B"][i % 4], None, "x", "y", "z", None, "d", i))
    return spark.createDataFrame(rows, SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def strange(spark):
    """Null and repeated ids, repeated rows."""
    rows = [(None, "a b c", "en", "s"), (None, "a b c", "en", "s"), (None, None, None, None), (3, "a b c", "en", "s"), (3, "a b c", "en", "s"), (3, "other words", "de", None),
            (4, None, None, None), (4, None, None, None), (5, "", "en", "s"), (6, "x " * 40, "en", "t"), (6, "x " * 40, "en", "t"), (7, " ".join(map(str, range(50))), "en", "t"), (7, " ".join(map(str, range(50))), "en", "t")]
    return spark.createDataFrame([(*r, None, "x", "y", "z", None, "d", 1) for r in rows], SCHEMA)


def same_rows(a, b):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)
