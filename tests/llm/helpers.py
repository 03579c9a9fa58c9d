"""Small tables with the odd cases every operator must bear: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

ODD = "doc_id long, text string, source string, key long, words string, n long, id long, label string, pos int, tag long"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = ["the", "of", "and", "to", *(f"w{r.randrange(4000)}" for _ in range(60))]
    return " ".join(r.choice(words) for _ in range(n))


def odd_texts() -> list[tuple]:
    shared = prose(1, 60)
    near = prose(2, 200).split()
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one"), (None, None), (6, "ONE"), (7, "two words"),
        (8, prose(3, 30000)), (9, "x" * 50000), (10, f"{prose(4, 50)} {shared} {prose(5, 40)}"), (11, f"{shared}\n{prose(6, 20)}"),
        (12, " ".join(near)), (13, " ".join(near[:100] + ["changed"] + near[101:])), (14, prose(7, 35)), (15, prose(7, 35)),
        (16, "ñandú Élan ÉLAN   mail me: a.b@c.de, +49 123 456789"), (17, "4111 1111 1111 1111 and 10.0.0.1 and 300.1.1.1"),
        (18, (prose(8, 10) + " ") * 20), (-19, prose(9, 80)),
    ]
    return rows


def odd_documents(spark, rows=None):
    rows = odd_texts() if rows is None else rows
    return spark.createDataFrame([(i, t, None if k % 5 == 0 else f"s{k % 3}", 1, "x", 2, None, "q", 7, 9) for k, (i, t) in enumerate(rows)], ODD)


def rows_of(df, *columns) -> list[tuple]:
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
