"""Plain versions of the operators, for small tables."""

import re
from collections import Counter, defaultdict


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    seen, out = Counter(), set()
    for i in range(max(1, len(words) - 4) if words else 0):
        gram = tuple(words[i:i + 5])
        seen[gram] += 1
        out.add((gram, seen[gram]))
    return words, out


def classes(rows, threshold=0.8, alike=0.9):
    """{row number: least id of its class} of (id, text) rows; None for a class without an id."""
    sets = [shingles(text) for _, text in rows]
    root, met = list(range(len(rows))), Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, (_, grams) in enumerate(sets):
        for gram in grams:
            holders[gram].append(i)
    for group in holders.values():
        met.update((a, b) for n, a in enumerate(group) for b in group[n + 1:])
    for (a, b), n in met.items():
        (wa, sa), (wb, sb) = sets[a], sets[b]
        if find(a) != find(b):
            most = int((1 - alike) * max(len(wa), len(wb)) + 1e-9)
            near = n >= threshold * (len(sa) + len(sb) - n) - 1e-9
            if near or sum((Counter(wa) & Counter(wb)).values()) >= max(len(wa), len(wb)) - most and edits(wa, wb) <= most:
                root[find(b)] = find(a)
    least = {}
    for i, (own, _) in enumerate(rows):
        if own is not None:
            least[find(i)] = min(own, least.get(find(i), own))
    return {i: least.get(find(i)) for i in range(len(rows))}


def smith_waterman(a, b, match=2, mismatch=-1, gap=-1):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, last[j - 1] + (match if x == y else mismatch), last[j] + gap, row[j - 1] + gap))
        best = max(best, max(row))
    return best


def without_boilerplate(rows, min_sites=10):
    """Texts of (text, site) rows with the lines of many sites taken out."""
    sites = defaultdict(set)
    for text, site in rows:
        for line in (text or "").split("\n"):
            if site is not None:
                sites[line.strip(" \t\r")].add(site)
    out = []
    for text, _ in rows:
        lines = text.split("\n") if text is not None else []
        gone = [line.strip(" \t\r") and len(sites[line.strip(" \t\r")]) >= min_sites for line in lines]
        own = any(line.strip(" \t\r") and not g for line, g in zip(lines, gone))
        out.append("\n".join(line for line, g in zip(lines, gone) if not g) if own else text)
    return out


def without_repeats(rows, window):
    """[(words, kept words)] of (id, text) rows: windows that start in a row with a smaller id lose their words."""
    split = [re.findall("[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    least = {}
    for (own, _), words in zip(rows, split):
        for i in range(len(words) - window + 1):
            gram = tuple(words[i:i + window])
            if own is not None and own <= least.get(gram, own):
                least[gram] = own
    out = []
    for (own, _), words in zip(rows, split):
        gone = set()
        for i in range(len(words) - window + 1):
            if own is not None and least[tuple(words[i:i + window])] < own:
                gone |= set(range(i, i + window))
        out.append((words, [w for i, w in enumerate(words) if i not in gone]))
    return out


def collocations(rows, min_count, longest, top):
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang) rows, by the definition."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang or ("und" if lang is None else lang)] += len(words)
            for k in range(1, longest + 1):
                counts["und" if lang is None else lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n, found = total[lang], []
        candidates = {p: a for p, a in f.items() if len(p) >= 2 and a >= min_count}
        for p, a in candidates.items():
            inside = any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for q, b in candidates.items())
            if not inside:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def alignment(rows, a, b, a_bytes, b_bytes):
    """{id: (A ids, B ids, groups, links)} of (id, text) rows, walking along both token lists."""
    out = {}
    for own, text in rows:
        out[own] = ([], [], "", [])
        if not text:
            continue
        first, second = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        whole = (" " + text).encode()
        if b"".join(a_bytes[i] for i in first) != whole or b"".join(b_bytes[i] for i in second) != whole:
            continue
        i = j = 0
        a_end, b_end = len(a_bytes[first[0]]), len(b_bytes[second[0]])
        links, groups, parts = [], [], ([first[0]], [second[0]])
        while True:
            links.append((first[i], second[j]))
            if a_end == b_end:
                groups.append("|".join(",".join(map(str, p)) for p in parts))
                parts = ([], [])
                if a_end == len(whole):
                    break
            go_a, go_b = a_end <= b_end, b_end <= a_end
            if go_a:
                i += 1
                a_end += len(a_bytes[first[i]])
                parts[0].append(first[i])
            if go_b:
                j += 1
                b_end += len(b_bytes[second[j]])
                parts[1].append(second[j])
        out[own] = (first, second, ";".join(groups), links)
    return out
