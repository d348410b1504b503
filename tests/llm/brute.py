"""Plain Python versions of what the operators compute, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SECRET = {
    "assign": r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        double = digit * 2 if place % 2 else digit
        total += double - 9 if double > 9 else double
    return total % 10 == 0


def _personal_ok(kind, text):
    digits = re.sub(r"[^0-9]", "", text)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(part) <= 255 for part in text.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def personal(text):
    """(kind, start, end) by kind as listed, then start."""
    text = text or ""
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PERSONAL.items()
        for m in re.finditer(pattern, text)
        if _personal_ok(kind, m.group())
    ]


def secrets(text):
    """(kind, start, end) by start, then kind as listed."""
    text = text or ""
    least = {"assign": lambda m: len(m.group(1)) >= 8, "access": lambda m: len(m.group()) >= 16, "hex": lambda m: len(m.group()) >= 32}
    spans = [
        (m.start(), place, kind, m.end())
        for place, (kind, pattern) in enumerate(SECRET.items())
        for m in re.finditer(pattern, text)
        if least[kind](m)
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def digest(spans):
    return sha(",".join(f"{kind}:{start}:{end}" for kind, start, end in spans))


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + j for i, window in enumerate(windows) if seen[window] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if len(words) < 3:
        return [" ".join(words)] if words else []
    return [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]


def fingerprint(text):
    import xxhash

    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles(text)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Smallest reachable node for each node, comparing all pairs."""
    nodes = list(nodes)
    root = {node: node for node in nodes}

    def find(node):
        while root[node] != node:
            node = root[node]
        return node

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {node: find(node) for node in nodes}


def prefix_nodes(rows):
    """All nodes of the trie of rebuilt conversations, from (conv_id, turn, role, text)."""
    told = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            told[conv].append((turn is not None, turn or 0, tie, role, text))
    told = {conv: [turn[3:] for turn in sorted(turns)] for conv, turns in told.items()}
    path = {}
    for conv, turns in told.items():
        h = zlib.crc32(str(conv).encode()) % 4
        path[conv] = told.get(conv - int(math.fmod(conv, 20)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for conv, turns in path.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
    children, leaves, saved = Counter(), Counter(), Counter()
    for prefix in members:
        if prefix:
            children[prefix[:-1]] += 1
    for prefix, convs in members.items():
        words = len(WORD.findall(prefix[-1][1])) if prefix else 0
        for depth in range(len(prefix) + 1):
            leaves[prefix[:depth]] += not children[prefix]
            saved[prefix[:depth]] += (len(convs) - 1) * words
    return [
        {
            "conv_id": min(convs),
            "depth": len(prefix),
            "parent_conv_id": min(members[prefix[:-1]]) if prefix else None,
            "n_convs": len(convs),
            "n_children": children[prefix],
            "n_leaves": leaves[prefix],
            "saved_tokens": saved[prefix],
            "ends_sha256": sha(",".join(map(str, sorted(c for c in convs if len(path[c]) == len(prefix))))),
        }
        for prefix, convs in members.items()
    ]


def best_documents(docs, items, k=10):
    """(item, rank, doc_id, score) from (doc_id, text) and (item, text), scoring every document."""
    term = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

    def count(text):
        return Counter(term.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")))

    counted = [(doc_id, terms) for doc_id, text in docs if (terms := count(text))]
    n, total = len(counted), sum(terms.total() for _, terms in counted)
    df = Counter(t for _, terms in counted for t in terms)
    out = []
    for item, text in items:
        scored = []
        for doc_id, terms in counted:
            m = 100 - 75 + (75 * terms.total() * n) // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * terms[t]) // (1000 * terms[t] + 8 * m))
                for t, times in count(text).items()
                if t in terms
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return out


def decision_list(rows, bins=32, most_rules=12, most_conditions=4, precise=0.97, share=0.002, chance=0.05):
    """Rules of (feature, above, limit) by sequential covering, from rows with ``junk`` and ``prunes``."""
    names = [name for name in rows[0] if name not in ("junk", "prunes")] if rows else []
    limits = {}
    for name in names:
        ordered = sorted(row[name] for row in rows)
        limits[name] = sorted({ordered[math.ceil(len(rows) * i / bins) - 1] for i in range(1, bins)})
    covers = lambda rule, row: all((row[f] > limit) == above for f, above, limit in rule)
    count = lambda some: (sum(r["junk"] for r in some), sum(not r["junk"] for r in some))
    purity = lambda junk, good: junk / (junk + good + 1)
    left, rules = list(rows), []
    n_prune = sum(r["junk"] for r in rows if r["prunes"])
    if not n_prune or n_prune == sum(r["junk"] for r in rows) or all(r["junk"] for r in rows):
        return []
    while len(rules) < most_rules:
        grow, prune = [r for r in left if not r["prunes"]], [r for r in left if r["prunes"]]
        rule = []
        while len(rule) < most_conditions:
            covered, best = [r for r in grow if covers(rule, r)], None
            before = purity(*count(covered))
            for name in names:
                for limit in limits[name]:
                    for above in (False, True):
                        junk, good = count([r for r in covered if covers([(name, above, limit)], r)])
                        if junk and before:
                            gain = junk * (math.log2(purity(junk, good)) - math.log2(before))
                            if gain > 0 and (best is None or gain > best[0]):
                                best = gain, (name, above, limit)
            if not best:
                break
            rule.append(best[1])
        all_junk, all_good = count(prune)
        chosen = None
        for n in range(1, len(rule) + 1):
            junk, good = count([r for r in prune if covers(rule[:n], r)])
            if junk < max(2, share * n_prune) or junk < precise * (junk + good):
                continue
            rate = all_junk / (all_junk + all_good)
            m = junk + good
            tail = sum(math.comb(m, k) * rate**k * (1 - rate) ** (m - k) for k in range(junk, m + 1))
            if rate < 1 and tail <= chance and (chosen is None or junk - 10 * good > chosen[0]):
                chosen = junk - 10 * good, n
        if chosen is None:
            break
        rules.append(rule[: chosen[1]])
        left = [r for r in left if not covers(rules[-1], r)]
    return rules
