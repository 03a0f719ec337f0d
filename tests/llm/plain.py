"""The operators' rules in plain Python, for small tables."""

from __future__ import annotations

import hashlib
import random
import re

SPACE = "[\x20\x09-\x0d]+"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def words(text: str | None) -> list[str]:
    return [w for w in re.split(SPACE, text or "") if w]


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """(doc_id, text): shared passages and lines, exact and near copies, odd white space, nulls, empty and long texts, repeated rows, in no order."""
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "Über", "naïve", "a", "x.", "co,", "don't", "世界", "\x1c", "é", "zig", "Zag", "12", "#!", "long", "İ.", "̂"]
    sentence = lambda k: " ".join(rnd.choice(vocabulary) for _ in range(k))
    passages = [sentence(k) for k in (49, 50, 51, 60, 90)]
    lines = ["Contact us here", "short", "Ünïcode9.", "  Ünïcode 10  ", "All rights reserved."]
    rows: list[tuple] = [(1000, None), (1001, ""), (1002, " \n\t\x0b "), (1003, "\n\n"), (1004, "one"), (1005, sentence(4000)), (1006, "the of a"), (1007, "THE of A")]
    for i in range(n):
        parts = []
        for _ in range(rnd.randint(1, 5)):
            parts.append(rnd.choice([rnd.choice(passages), rnd.choice(lines), sentence(rnd.randint(1, 70))]))
        rows.append((i, rnd.choice(["\n", " ", " \r\n", "  "]).join(parts)))
    rows += [(100 + i, rows[10 + i][1]) for i in range(6)] + [(110 + i, rows[20 + i][1].replace(" ", "\t ")) for i in range(4)]
    rows += [(120 + i, rows[10 + i][1] + " tail") for i in range(4)] + [rows[12], (rows[13][0], "another text of the same id")]
    rnd.shuffle(rows)
    return rows


def components(n: int, links: list[tuple[int, int]]) -> list[int]:
    """The smallest index that each index reaches."""
    root = list(range(n))
    for _ in range(n):
        before = list(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
        if before == root:
            break
    return root


def near(ids: list, keys: list, linked) -> list:
    links = [(i, j) for i in range(len(ids)) for j in range(i) if linked(keys[i], keys[j])]
    order = sorted(range(len(ids)), key=lambda i: ids[i])
    place = {i: k for k, i in enumerate(order)}
    root = components(len(ids), [(place[a], place[b]) for a, b in links])
    return [ids[order[root[place[i]]]] for i in range(len(ids))]
