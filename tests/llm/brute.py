"""Plain Python versions of the contracts, row by row; only for small tables."""

import hashlib
import re
from collections import defaultdict

import xxhash

UPPER = {c: c + 32 for c in range(65, 91)}
SPACE = re.compile(r"[\x20\x09-\x0D]+")
NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def low(t):
    return (t or "").translate(UPPER)


def simhash(rows):
    prints = []
    for _, t in rows:
        words = NOT_SPACE.findall(low(t))
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs)) if hs else 0)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, f"{p:016x}", least[root(i)]) for i, ((d, _), p) in enumerate(zip(rows, prints)))


def near_copies(rows, words=5, similarity=0.8):
    """rows: (doc_id, text). The smallest id of the group of each row, by links of sets of shingles."""
    sets = []
    for _, t in rows:
        w = NOT_SPACE.findall(low(t))
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for (d, _), g in zip(rows, group):
        least[g] = min(least.get(g, d), d)
    return [least[g] for g in group]


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii(text):
    spans = []
    for k, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                spans.append((m.start(), k, kind, m.end()))
    spans.sort()
    return [sum(s[2] == k for s in spans) for k in KINDS], sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)), [(k, a, b) for a, _, k, b in spans]


def pii_terms(rows, chars=256, generalise=0.75, remove=0.95, letters=3):
    """rows: (doc_id, text), all different. (start, end, put) of the disclosing terms of each row, found by counting passages."""
    import math

    import regex

    words = [[(m.start(), m.end(), m[0].lower()) for m in regex.finditer(r"\p{L}+", t or "")] for _, t in rows]
    spans = [pii(t)[2] for _, t in rows]
    total = sum(-(-len(t or "") // chars) for _, t in rows)
    n_term, n_entity, n_both = defaultdict(int), defaultdict(int), defaultdict(int)
    for (_, t), own, found in zip(rows, words, spans):
        terms, entities = defaultdict(set), defaultdict(set)
        for a, _, w in own:
            terms[a // chars].add(w)
        for k, a, b in found:
            entities[a // chars].add(f"{k}:{t[a:b].lower()}")
        for g, ws in terms.items():
            for w in ws:
                n_term[w] += 1
                for e in entities[g]:
                    n_both[e, w] += 1
        for es in entities.values():
            for e in es:
                n_entity[e] += 1

    def share(e, both, many):
        ic = -math.log2(n_entity[e] / total)
        return math.log2(total * both / (many * n_entity[e])) / ic if ic > 0 else 0

    puts = {}
    for (e, w), both in n_both.items():
        s = share(e, both, n_term[w])
        if s < generalise:
            continue
        length = 0
        for n in range(len(w) - 1, letters - 1, -1) if s < remove else ():
            many = sum(c for x, c in n_term.items() if x[:n] == w[:n] and len(x) > n)
            beside = sum(c for (f, x), c in n_both.items() if f == e and x[:n] == w[:n] and len(x) > n)
            if share(e, min(beside, n_entity[e]), many) < generalise:
                length = n
                break
        puts[w] = min(puts.get(w, length), length)
    out = {}
    for (d, _), own, found in zip(rows, words, spans):
        out[d] = [(a, b, f"{w[:puts[w]]}*" if puts[w] else "") for a, b, w in own if w in puts and not any(x < b and a < y for _, x, y in found)]
    return out


def decontaminate_any(docs, bench):
    windows = defaultdict(set)
    for item, t in bench:
        w = WORD.findall(low(t))
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if w else ():
            windows[tuple(w[i : i + n])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        words, hit, items = WORD.findall(low(t)), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                own = windows.get(tuple(words[i : i + n]))
                if own:
                    hit.update(range(i, i + n))
                    items |= own
        out.append((d, len(words), len(hit), len(items), sha(",".join(sorted(items))), bool(hit)))
    return out


def decontaminate(docs, bench):
    return sorted(decontaminate_any(docs, bench))


def exact(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[SPACE.sub(" ", t or "")].append(d)
    return sorted((d, min(g), len(g), d == min(g), sha(t)) for t, g in groups.items() for d in g)


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def licenses(text):
    words, found = WORD.findall(low(text)), []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    at = [i for i, _ in found]
    return len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def chat(rows):
    """rows: (conv_id, turn, role, text)"""
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        talks[c].append((turn, role, text or ""))
    out = []
    for c, turns in talks.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss)))
    return sorted(out)
