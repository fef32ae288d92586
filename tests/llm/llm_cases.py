"""Small tables with everything that may go wrong in them, and plain helpers."""

import random

import pyarrow as pa

WORDS = "alpha beta gamma delta kappa lambda sigma omega rho tau phi psi".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def hard_texts():
    """Texts with nulls, empties, copies, near copies, shared passages and a very long one."""
    base, passage = prose(1, 120), prose(2, 60)
    near = base.split()
    near[50] = "changed"
    long = prose(3, 5000)
    return [
        (0, base),
        (1, base),
        (2, " ".join(near)),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, prose(6, 40) + "\n" + passage + " " + prose(7, 30)),
        (7, passage + "  " + prose(8, 5)),
        (8, prose(9, 2)),
        (9, prose(9, 2)),
        (10, long),
        (11, long + " tail"),
        (12, "word " * 100),
        (13, "ÄÖ ß\x0bé日本 語 ünï cödé " * 12),
        (14, prose(14, 19)),
        (15, prose(14, 19)),
        (16, prose(16, 20)),
        (17, prose(16, 20).upper()),
        (18, prose(18, 200) + " " + prose(18, 200)),
        (19, prose(19, 3)),
        (None, prose(6, 40)),
        (21, "\x1c one two \x85 "),
        (21, "\x1c one two \x85 "),
    ]


def documents(rows, **columns):
    """A table of documents; some columns have names that operators might use themselves."""
    n = len(rows)
    table = {
        "doc_id": pa.array([r[0] for r in rows], pa.int64()),
        "text": pa.array([r[1] for r in rows], pa.string()),
        "lang": pa.array([None if i % 5 == 0 else "en" for i in range(n)], pa.string()),
        "source": pa.array([None if i % 7 == 0 else f"s{i % 3}" for i in range(n)], pa.string()),
        "n_chars": pa.array([0 if r[1] is None else len(r[1]) for r in rows], pa.int64()),
    }
    for clash in ("key", "hash", "size", "shard", "row", "fingerprint", "root", "score", "rank"):
        table[clash] = pa.array([i % 2 for i in range(n)], pa.int32())
    for name, values in columns.items():
        table[name] = values
    return pa.table(table)


def components(ids, links):
    """The smallest id each id reaches."""
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}
