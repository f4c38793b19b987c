"""The merge rules over lists of dicts, to compare the Spark operators with."""

from __future__ import annotations

from collections import Counter


def bag(rows):
    return Counter(tuple(sorted(r.items(), key=lambda kv: kv[0])) for r in rows)


def bag_of(df):
    return bag(r.asDict() for r in df.collect())


def merge(target, updates, on, matched="all", not_matched="all", columns=()):
    """``matched`` is "all", None, or a function (target row, update row) -> new target row."""

    def key(row):
        values = tuple(row[c] for c in on)
        return None if None in values else values

    by_key = {}
    for u in updates:
        if key(u) is not None:
            by_key.setdefault(key(u), []).append(u)
    result, hit = [], set()
    for t in target:
        partners = by_key.get(key(t), [])
        if not partners or matched is None:
            result.append({**{c: None for c in columns}, **t})
        else:
            assert len(partners) == 1, "ambiguous"
            new = {**t, **partners[0]} if matched == "all" else matched(t, partners[0])
            result.append({**{c: None for c in columns}, **new})
        if key(t) is not None:
            hit.add(key(t))
    if not_matched == "all":
        result += [{**{c: None for c in columns}, **u} for u in updates if key(u) not in hit]
    return result
