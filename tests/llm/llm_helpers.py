"""Made-up text, and plain versions of what the operators compute."""

import hashlib
import random
import re
from collections import Counter

import xxhash

WORD = r"[^\x20\x09-\x0D]+"

WORDS = "the of river stone runs over green hills and never stops at night".split()


def sentence(rng: random.Random, n_words: int) -> str:
    words = [rng.choice(WORDS) + rng.choice(["", "s", "ed"]) for _ in range(n_words)]
    return " ".join(words).capitalize() + "."


def repeats(rows, W=50):
    """Per row: bytes, bytes removed, runs removed, and what is left."""
    first = {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for p in range(len(text) - W + 1):
            first.setdefault(text[p : p + W], i)
    out = []
    for i, text in rows:
        gone = bytearray(len(text))
        for p in range(len(text) - W + 1):
            if i is not None and first[text[p : p + W]] < i:
                gone[p : p + W] = b"\1" * W
        runs = len(bytes(gone).replace(b"\0", b" ").split())
        left = bytes(c for c, g in zip(text, gone) if not g)
        out.append((i, len(text), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def labels(ids, fps, max_bits=4):
    """Smallest id reachable, by brute force over all pairs."""
    label = dict(zip(range(len(ids)), ids))
    links = [
        (i, j) for i in range(len(ids)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= max_bits
    ]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            least = min(label[i], label[j])
            if label[i] != least or label[j] != least:
                label[i] = label[j] = least
                changed = True
    return label


def base_counts(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    n, repeat = len(words), len(covered)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        repeat,
        n < 20 or 100 * repeat > 30 * n,
    )


def shared(budget, children):
    """Budget shared by weight up to capacity: ``children`` are ``(weight, cap)``."""
    given = [0] * len(children)
    open_ = [i for i, (w, _) in enumerate(children) if w]
    while open_:
        weights = sum(children[i][0] for i in open_)
        left = budget - sum(given)
        full = [i for i in open_ if children[i][1] * weights <= left * children[i][0]]
        if not full:
            for i in open_:
                given[i] = left * children[i][0] // weights
            break
        for i in full:
            given[i] = children[i][1]
        open_ = [i for i in open_ if i not in full]
    return given


def budgets(leaves, mix, total):
    """By hand: down the tree, a node's budget shared among its children."""

    def weight(path):
        tables = [{d: w for d, (w, _) in mix.domains.items()}, mix.languages, mix.sources]
        return tables[len(path) - 1].get(path[-1], 1)

    def room(path):
        out = 0
        for leaf, tokens in leaves.items():
            if leaf[: len(path)] == path:
                out += 0 if any(not weight(leaf[: k + 1]) for k in range(3)) else tokens
        return out * mix.max_epochs

    def down(path, budget):
        if len(path) == 3:
            return {path: budget}
        children = sorted({leaf[: len(path) + 1] for leaf in leaves if leaf[: len(path)] == path})
        found = shared(budget, [(weight(c), room(c)) for c in children])
        return {k: v for c, b in zip(children, found) for k, v in down(c, b).items()}

    return down((), total)


def mixed_ids(rows, mix):
    """Ids chosen once or more by ``mix``, of ``(doc_id, text, lang, source)``; ids are unique."""
    domain = {s: d for d, (_, sources) in mix.domains.items() for s in sources}
    leaves, members = {}, {}
    for i, text, lang, source in rows:
        path = (domain.get(source or "", "other"), lang or "", source or "")
        n = len(re.findall(WORD, text or ""))
        leaves[path] = leaves.get(path, 0) + n
        members.setdefault(path, []).append((i, n))
    total = sum(leaves.values()) * mix.share[0] // mix.share[1]
    chosen = Counter()
    for path, budget in budgets(leaves, mix, total).items():
        if not budget:
            continue
        whole, left = divmod(budget, leaves[path])
        chosen.update({i: whole for i, _ in members[path] if whole})
        if whole == mix.max_epochs:
            continue

        def place(member):
            return hashlib.md5(f"{mix.seed}-{whole}-{member[0]}".encode()).hexdigest()

        for i, n in sorted(members[path], key=place):
            left -= n
            if left < 0:
                break
            chosen[i] += 1
    return chosen
