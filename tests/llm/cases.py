"""Small documents with nulls, empty, long, repeated and tied rows."""

import random

SCHEMA = "doc_id long, text string, row string, id string, th int, n long"


def texts(seed: int = 1) -> list:
    r = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "délta", "the", "of", "under", "mit", "license", "apache", "version", "2", "x", "日本", "#", "a|b"]
    line = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared, passage = line(12), line(120)
    plain = [None, "", " ", "\n", "\n\n", "a", "Ünïcode Ä ß 日本語", "x" * 3000, "  spaced   out\t text \r\n", "tab\tonly", "  odd \x1c spaces\x85 here end"]
    docs = plain + [line(r.randint(1, 60)) for _ in range(12)]
    docs += ["\n".join([line(6), "  " + shared.upper() + " ", line(9), shared]) for _ in range(5)]
    docs += [line(20) + passage + line(20) for _ in range(4)]
    base = [r.choice(words) for _ in range(300)]
    for k in range(8):
        other = list(base)
        other[k * 7] = "changed"
        docs.append(" ".join(other))
    return docs + [docs[12], docs[12], docs[30], line(5000)]


def rows(seed: int = 1) -> list:
    """Ids in shuffled order; columns whose names clash with internal ones; one null id; a repeated row."""
    found = [(i * 3, t, f"r{i}", "other", i, i) for i, t in enumerate(texts(seed))]
    found += [(None, "nobody's text of the null id", "r", "o", 0, 0), found[14]]
    random.Random(seed).shuffle(found)
    return found


def frame(spark, seed: int = 1):
    return spark.createDataFrame(rows(seed), SCHEMA)
