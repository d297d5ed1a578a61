"""Plain forms of the document operators, one text at a time, for comparison."""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib

import numpy as np

RULES = (
    ("assign", re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


def secrets(text: str | None) -> tuple:
    found = []
    for k, (kind, pattern, group, least) in enumerate(RULES):
        found += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if len(m[group]) >= least]
    spans = ",".join(x[2] for x in sorted(found))
    n = [sum(x[1] == k for x in found) for k in range(3)]
    return (*n, hashlib.sha256(spans.encode()).hexdigest(), spans)


def token_files(docs: list[tuple], path: str) -> list[tuple]:
    from tokenizers import Tokenizer

    tok, out, start = Tokenizer.from_file(path), [], 0
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def edited(docs: list[tuple]) -> dict:
    """doc_id -> (n_chars, sha256 of the edited text)."""
    docs = sorted(docs, key=lambda d: d[0])
    out = {}
    for k, (doc_id, text) in enumerate(docs):
        text, following = text or "", docs[(k + 1) % len(docs)][1] or ""
        cut = len(text) // 4
        out[doc_id] = (len(text), hashlib.sha256((text[: len(text) - cut] + following[:cut]).encode()).hexdigest())
    return out


def chats(rows: list[tuple]) -> dict:
    """conv_id -> (turns, sha256 of the turns, code points and sha256 of the assistant's texts)."""
    by: dict = {}
    for conv_id, turn, role, text in rows:
        by.setdefault(conv_id, []).append((turn, role or "", text or ""))
    out = {}
    for conv_id, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv_id] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def shingles(text: str | None, k: int) -> set:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def near_duplicates(docs: list[tuple], k: int, pct: int) -> dict:
    """doc_id -> (size of its set, component), every pair with a common shingle compared."""
    sets = {d: shingles(t, k) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where: dict = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    for d, s in sets.items():
        common: dict = {}
        for x in s:
            for other in where[x]:
                if other > d:
                    common[other] = common.get(other, 0) + 1
        for other, n in common.items():
            if 100 * n >= pct * (len(s) + len(sets[other]) - n):
                a, b = find(d), find(other)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def repeats(docs: list[tuple], length: int) -> list[tuple]:
    """(doc_id, bytes, removed, spans, sha256 of the rest) of each row."""
    raws = [(d, (t or "").encode()) for d, t in docs]
    count: dict = {}
    for _, raw in raws:
        for i in range(len(raw) - length + 1):
            count[hash(raw[i : i + length])] = count.get(hash(raw[i : i + length]), 0) + 1
    out = []
    for d, raw in raws:
        gone = np.zeros(len(raw) + 1, dtype=np.int64)
        for i in range(len(raw) - length + 1):
            if count[hash(raw[i : i + length])] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        covered = np.cumsum(gone)[: len(raw)] > 0
        spans = int(np.sum(np.diff(np.concatenate(([0], covered.astype(int)))) == 1))
        kept = np.frombuffer(raw, np.uint8)[~covered].tobytes()
        out.append((d, len(raw), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def fill_middle(doc_id: int | None, text: str | None, seed: int = 7, pattern: str = r"[^\n]*\n|[^\n]+") -> tuple:
    """(n, form, prefix and middle code points, sha256 of the output, sha256 of the text) of one text."""
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = re.findall(pattern, text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    plain = not text or any(x in text for x in ("<P>", "<S>", "<M>"))
    form = "plain" if plain else "spm" if h4 % 100 < 50 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (out, text)]
    return (len(units), form, None if plain else len(p), None if plain else len(m), *sha)


WHITE = " \t\n\x0b\x0c\r"


def damage(rows: list[tuple]) -> list[tuple]:
    """(conv_id, turn, role, text) after the damage that CRC-32 of ``conv_id:turn`` does."""
    out = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        h = zlib.crc32(key.encode()) % 20
        row = (conv_id, turn, "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text)
        out += [] if h == 0 else [row, row] if h == 3 else [row]
    return out


def cheapest(rows: list[tuple[str, str]], cost=(0, 1, 2, 5, 5)) -> tuple[int, str, list[str]]:
    """(cost, least edit string, initials of the result) of (role, fault) by search over all edit strings in order.

    ``fault`` is "", "blank", "duplicate" or "truncated".
    """
    keep, rerole, delete, insert, cut = cost
    heap: list = [(0, "", 0, "")]  # cost, edits, rows done, initials so far (the last two letters tell the state)
    seen: set = set()
    while True:
        spent, done, i, said = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            return spent, done, said
        state = (i, "" if not said else said[-1])
        if state in seen:
            continue
        seen.add(state)
        ways = [("I", x, i, insert) for x in "ua"]
        if i < len(rows):
            role, fault = rows[i]
            ways.append(("D", "", i + 1, delete))
            if fault not in ("blank", "duplicate"):
                extra = cut if fault == "truncated" else 0
                ways += [("K", role[:1], i + 1, keep + extra)] if role else []
                ways += [("R", x, i + 1, rerole + extra) for x in "ua"]
        for letter, x, j, more in ways:
            if re.fullmatch("(s?(ua)*u?)?", said + x):
                heapq.heappush(heap, (spent + more, done + letter, j, said + x))


def repaired(rows: list[tuple], ids: set, cost=(0, 1, 2, 5, 5)) -> dict:
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256 of the repaired turns)."""
    by: dict = {c: [] for c in ids}
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        mark = hashlib.sha256(text.encode()).hexdigest()
        by[conv_id].append((turn is not None, turn or 0, role, mark, text))
    out = {}
    for conv_id, own in by.items():
        own.sort()
        known = {t for ok, t, *_ in own if ok}
        faults, earlier = [], set()
        for *_, role, _, text in own:
            said = text.strip(WHITE)
            faults.append("blank" if not said else "duplicate" if (role, text) in earlier else "truncated" if said[-1] not in ".!?" else "")
            earlier.add((role, text))
        roles = [r for _, _, r, _, _ in own]
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
        spent, audit, said = cheapest(list(zip(roles, faults, strict=True)), cost)
        lines, i, left = [], 0, iter(said)
        for letter in audit:
            if letter != "D":
                x = next(left)
                name = roles[i] if letter == "K" else {"u": "user", "a": "assistant"}[x]
                lines.append(f"{name}:{'' if letter == 'I' else own[i][4]}")
            i += letter != "I"
        n = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        out[conv_id] = (gaps, *n, illegal, spent, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out
