"""Plain versions of the text operators, for small inputs."""

from __future__ import annotations

import itertools
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, width):
    words = WORD.findall(lower(text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def components(nodes, linked):
    """{node: least node of its component}, by flooding."""
    around = {n: set() for n in nodes}
    for a, b in linked:
        around[a].add(b)
        around[b].add(a)
    out = {}
    for n in sorted(nodes):
        if n not in out:
            todo = [n]
            while todo:
                if (x := todo.pop()) not in out:
                    out[x] = n
                    todo.extend(around[x])
    return out


def jaccard(rows, width, share):
    """{doc_id: (n_shingles, component_id)} of (doc_id, text) rows with distinct ids."""
    sets = {d: shingles(t, width) for d, t in rows}
    holds = {}
    for d, s in sets.items():
        for x in s:
            holds.setdefault(x, []).append(d)
    pairs = {p for ds in holds.values() for p in itertools.combinations(sorted(ds), 2)}
    linked = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])]
    group = components(sets, linked)
    return {d: (len(s), group[d]) for d, s in sets.items()}


def leaks(rows, items, width=5, share=0.8):
    known = {i: shingles(t, width) for i, t in items}
    out = set()
    for d, t in rows:
        words = WORD.findall(lower(t))
        own = {tuple(words[i : i + k]) for k in range(1, width + 1) for i in range(len(words) - k + 1)}
        out |= {(d, i, len(own & s), len(s)) for i, s in known.items() if s and len(own & s) >= share * len(s) - 1e-9}
    return out


def line_words(x):
    return [w for w in re.split("[ \t\x0b\x0c\r]+", x) if w]


def one_edit(a, b):
    a, b = sorted((line_words(a), line_words(b)), key=len)
    if len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def line_dedup(rows, least=5):
    """{doc_id: (text, n_exact, n_near)} of (doc_id, text) rows with distinct ids."""
    return {d: rest for (d, *_), rest in zip(rows, line_dedup_rows(rows, least))}


def line_dedup_rows(rows, least=5):
    """(text, n_exact, n_near) of each of the (doc_id, text) rows, which may repeat; equal ids come in order of the rows."""
    first, order = {}, sorted(range(len(rows)), key=lambda r: (rows[r][0] is not None, rows[r][0] or 0, r))
    lines = [(r, i, x) for r in order if rows[r][1] is not None for i, x in enumerate(rows[r][1].split("\n"))]
    fit = [(r, i, x) for r, i, x in lines if x.strip(" \t\x0b\x0c\r")]
    for place, x in enumerate(x for _, _, x in fit):
        first.setdefault(x, place)
    distinct = [x for x in sorted(first, key=first.get) if len(line_words(x)) >= least]
    near = {x for k, x in enumerate(distinct) if any(one_edit(x, y) for y in distinct[:k])}
    gone = {}
    for place, (r, i, x) in enumerate(fit):
        if x in near or place != first[x]:
            gone.setdefault(r, {})[i] = x in near
    out = []
    for r, (_, t) in enumerate(rows):
        mine = gone.get(r, {})
        kept = t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in mine)
        out.append((kept, sum(not v for v in mine.values()), sum(mine.values())))
    return out


def pitman_yor(dish, context, counts, kind, discounts, theta, types, burn_in, samples, seed=1):
    """Averaged predictions of (dish, context) entries; restaurants: contexts, their kinds, the root; tables are lists of sizes."""
    rnd = random.Random(seed)
    tables = [{}, {}, {}]
    totals = [{}, {}, {}]

    def at(level, c):
        return (c, int(kind[c]), 0)[level]

    def p(level, w, c):
        if level == 3:
            return 1 / (types + 1)
        own = tables[level].get((at(level, c), w), [])
        n, t = totals[level].get(at(level, c), (0, 0))
        return (sum(own) - discounts[level] * len(own) + (theta + discounts[level] * t) * p(level + 1, w, c)) / (theta + n)

    def change(level, c, n, t):
        a, b = totals[level].get(at(level, c), (0, 0))
        totals[level][at(level, c)] = (a + n, b + t)

    def sit(level, w, c):
        if level == 3:
            return
        own = tables[level].setdefault((at(level, c), w), [])
        d, t = discounts[level], totals[level].get(at(level, c), (0, 0))[1]
        weights = [n - d for n in own] + [(theta + d * t) * p(level + 1, w, c)]
        k = rnd.choices(range(len(weights)), weights)[0]
        if k == len(own):
            own.append(0)
            sit(level + 1, w, c)
            change(level, c, 0, 1)
        own[k] += 1
        change(level, c, 1, 0)

    def rise(level, w, c):
        if level == 3:
            return
        own = tables[level][at(level, c), w]
        k = rnd.choices(range(len(own)), own)[0]
        own[k] -= 1
        change(level, c, -1, 0)
        if not own[k]:
            own.pop(k)
            change(level, c, 0, -1)
            rise(level + 1, w, c)

    customers = [(int(w), int(c)) for w, c, n in zip(dish, context, counts) for _ in range(int(n))]
    for w, c in customers:
        sit(0, w, c)
    out = [0.0] * len(dish)
    for sweep in range(burn_in + samples):
        for w, c in customers:
            rise(0, w, c)
            sit(0, w, c)
        if sweep >= burn_in:
            for k, (w, c) in enumerate(zip(dish, context)):
                out[k] += p(0, int(w), int(c)) / samples
    return out
