"""Plain versions of the operators, for small inputs."""

import re
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(_LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_components(docs, percent=85):
    """doc_id -> smallest reachable doc_id, over {doc_id: text}."""
    sets = {d: shingles(t) for d, t in docs.items()}
    root = {d: d for d in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in combinations(sorted(d for d in docs if sets[d]), 2):
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {d: find(d) for d in docs}


def without_repeated_runs(docs, least=50):
    """{doc_id: text} -> {doc_id: (text, removed lines)}: every run of lines of ``least`` words
    that occurs at an earlier start goes, with the wordless lines in it."""
    lines = {d: (t or "").split("\n") for d, t in docs.items()}
    rows = {
        d: [(i, x, len(WORD.findall(x))) for i, x in enumerate(ls) if WORD.search(x)]
        for d, ls in lines.items()
    }
    first, gone = {}, {d: set() for d in docs}
    for d in sorted(docs):
        for a in range(len(rows[d])):
            words = 0
            for b in range(a, len(rows[d])):
                words += rows[d][b][2]
                if words < least:
                    continue
                # Longer runs hold a minimal one at each end; those two cover or touch.
                run = tuple(x for _, x, _ in rows[d][a : b + 1])
                minimal = words - rows[d][a][2] < least or words - rows[d][b][2] < least
                if not minimal:
                    break
                if first.setdefault(run, (d, a)) != (d, a):
                    gone[d].update(range(rows[d][a][0], rows[d][b][0] + 1))
    return {
        d: (
            None
            if docs[d] is None
            else "\n".join(x for i, x in enumerate(lines[d]) if i not in gone[d]),
            len(gone[d]),
        )
        for d in docs
    }


def mix_targets(sizes, most=3):
    """{source: size} -> {source: target}: excess over the limit is shared again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    open_ones, left = set(order), float(sum(sizes.values()))
    while open_ones and left > 1e-9:
        total = sum(weight[s] for s in open_ones)
        over = [s for s in open_ones if left * weight[s] / total >= most * sizes[s]]
        if not over:
            for s in open_ones:
                target[s] = left * weight[s] / total
            break
        for s in over:
            target[s] = float(most * sizes[s])
        left -= sum(target[s] for s in over)
        open_ones -= set(over)
    return target


def check_sequences(rows, ids_of, length=4096):
    """Pieces cover each document once, sequences are gapless and full but for one."""
    import zlib

    import numpy as np

    documents, sequences = {}, {}
    for r in rows:
        documents.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for doc, pieces in documents.items():
        ids = ids_of[doc]
        copies = sum(p.start == 0 for p in pieces)
        assert sum(p.length for p in pieces) == copies * len(ids)
        for p in pieces:
            part = np.array(ids[p.start : p.start + p.length], "<u4")
            assert p.doc_tokens == len(ids) and len(part) == p.length > 0
            assert zlib.crc32(part.tobytes()) == p.ids_crc32
        covered = sorted((p.start, p.length) for p in pieces)
        if copies == 1:
            assert all(a + n == b for (a, n), (b, _) in zip(covered, covered[1:]))
    totals = []
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        totals.append(at)
    assert max(totals, default=0) <= length
    assert sum(t < length for t in totals) <= 1
    return documents


def url_verdict(url, sites, patterns):
    """host, path, deciding site and verdict of one URL: every rule is tried."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for rule in sites:
        name, slash, start = rule.partition("/")
        name = name.lower()
        if (host == name or host.endswith("." + name)) and path.startswith(slash + start):
            if best is None or (-len(rule), rule) < (-len(best), best):
                best = rule
    if best is not None:
        return host, path, best, sites[best]

    def fits(pattern):
        front, back = "", ""
        if pattern.startswith("||"):
            front, pattern = r"\A(?:[^/]*\.)?", pattern[2:]
        elif pattern.startswith("|"):
            front, pattern = r"\A", pattern[1:]
        if pattern.endswith("|"):
            back, pattern = r"\Z", pattern[:-1]
        edge = r"(?:\A|[^A-Za-z0-9]|\Z)"
        signs = {"*": ".*", "^": edge}
        body = "".join(signs.get(c, re.escape(c)) for c in pattern)
        return re.search(front + body + back, host + path, re.S | re.I | re.A)

    verdicts = {v for p, v in patterns.items() if fits(p)}
    return host, path, None, "block" if verdicts == {"block"} else "allow"


def aligned(texts, path_a, path_b):
    """Rows of the alignment of each text, token by token from the libraries' own output."""
    import hashlib

    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    byte_of = {chr(x): x for x in shown}
    byte_of |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    made, counts, best = [], {}, {}
    for text in texts:
        whole = (" " + (text or "")).encode()
        left = right = []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids
            left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in ids]
            for i in b.encode(text):
                piece = b.id_to_piece(i)
                raw = bytes([int(piece[3:5], 16)]) if b.is_byte(i) else None
                right = [*right, (i, raw or piece.replace("▁", " ").encode())]
            if whole != b"".join(t for _, t in left) or whole != b"".join(t for _, t in right):
                left = right = []
        groups, links, x, y = [], [], 0, 0
        while x < len(left):
            ga, gb = [left[x]], [right[y]]
            size_a, size_b = len(left[x][1]), len(right[y][1])
            while size_a != size_b:
                if size_a < size_b:
                    x += 1
                    ga.append(left[x])
                    size_a += len(left[x][1])
                else:
                    y += 1
                    gb.append(right[y])
                    size_b += len(right[y][1])
            x, y = x + 1, y + 1
            groups.append("|".join(",".join(str(i) for i, _ in g) for g in (ga, gb)))
            links.append((ga[-1][0], gb[-1][0]))
            counts[links[-1]] = counts.get(links[-1], 0) + 1
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        made.append((len(left), len(right), len(groups), links, sha))
    for (_, i), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    return [
        (
            *(n_a, n_b, n_groups, len(links)),
            sum(counts[p] == best[p[1]] for p in links),
            sum(counts[p] for p in links),
            sha,
        )
        for n_a, n_b, n_groups, links, sha in made
    ]


def conversation_nodes(rows, share=5, most=9):
    """Rows of the trie of rebuilt conversations, from (conv_id, turn, role, text)."""
    import hashlib
    import zlib

    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, turns in own.items():
        head = zlib.crc32(str(c).encode()) % most
        lender = c - (c % share if c >= 0 else -(-c % share))
        whole[c] = tuple(own.get(lender, [])[:head] + turns[head:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for key, cs in members.items():
        below = [k for k in members if k[: len(key)] == key]
        leaves = [k for k in below if not any(m[:-1] == k for m in members if m)]
        saved = sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in below if k)
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(whole[c]) == len(key)))
        out.append(
            (
                min(cs),
                len(key),
                min(members[key[:-1]]) if key else None,
                len(cs),
                sum(1 for m in members if m and m[:-1] == key),
                len(leaves),
                saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return out


def _luhn(digits):
    total = 0
    for place, sign in enumerate(reversed(digits)):
        value = int(sign) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def personal_mentions(text):
    """(start, end, kind, identity) of the forms that the test tables have, found by walking
    along the text: addresses, +1 phones, secrets behind labels, IP addresses, card numbers."""
    local = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
    found = []
    for at in (i for i, c in enumerate(text) if c == "@"):
        start = at
        while start and text[start - 1] in local:
            start -= 1
        end = at + 1
        while end < len(text) and (text[end] in local or text[end] == "-") and text[end] not in "_%+":
            end += 1
        labels = text[at + 1 : end].split(".")
        while labels and not (labels[-1].isalpha() and len(labels[-1]) > 1):
            labels.pop()
        if start < at and len(labels) > 1:
            end = at + 1 + len(".".join(labels))
            found.append((start, end, "email", text[start:end].lower()))
    for at in (i for i, c in enumerate(text) if text.startswith("+1 (", i)):
        number = text[at : at + 17]
        if len(number) == 17 and number[7:9] == ") " and number[12] == "-":
            digits = "".join(c for c in number if c.isdigit())
            if len(digits) == 11 and not text[at + 17 : at + 18].isdigit():
                found.append((at, at + 17, "phone", digits))
    for label in ("password", "passwd", "pwd", "token", "secret", "api_key", "api-key", "apikey"):
        at = text.lower().find(label)
        while at >= 0:
            rest = text[at + len(label) :]
            sign = rest.lstrip(" ")
            value = sign[1:].lstrip(" ")
            if sign[:1] in ("=", ":") and value:
                quoted = value[0] in "\"'"
                body = value[quoted:]
                body = re.match(r"[^\s\"']*", body).group().rstrip(".,;:)]}>")
                start = text.index(body, at + len(label)) if body else at
                long_one = len(body) >= 6 and any(c.isdigit() for c in body)
                if long_one or sign[0] == "=" and len(body) >= 4 and any(c.isalnum() for c in body):
                    found.append((start, start + len(body), "secret", body))
            at = text.lower().find(label, at + 1)
    at = 0
    while at < len(text):
        end = at
        while end < len(text) and (text[end] in "0123456789."):
            end += 1
        run = text[at:end].rstrip(".")
        parts = run.split(".")
        before, after = text[at - 1 : at], text[at + len(run) : at + len(run) + 1]
        octets = {str(n) for n in range(256)} | {f"0{n}" for n in range(10)}
        if len(parts) == 4 and set(parts) <= octets:
            found.append((at, at + len(run), "ip", run))
        beside = any(c.isascii() and c.isalnum() for c in (before, after))
        if run.isdigit() and 13 <= len(run) <= 19 and _luhn(run) and not beside:
            found.append((at, at + len(run), "card", run))
        at = max(end, at + 1)
    # What lies inside another mention is part of it.
    return [
        m
        for m in sorted(found)
        if not any(o[0] <= m[0] and m[1] <= o[1] and o != m for o in found)
    ]


def language_features(text, orders=3, cells=1 << 13):
    """Square roots of the shares of hashed character n-grams, gram by gram; blanks stand for
    what is no letter, and grams without a letter don't count."""
    import math

    low = f" {(text or '').lower()} "
    counts = {}
    for order in range(orders):
        for start in range(len(low) - order):
            gram = low[start : start + order + 1]
            if not any(c.isalpha() for c in gram):
                continue
            value = 0
            for c in gram:
                value = (value * 0x100000001B3 + (ord(c) if c.isalpha() else 32)) % 2**64
            cell = ((value + order) * 0x9E3779B97F4A7C15 % 2**64) * cells >> 64
            counts[cell] = counts.get(cell, 0) + 1
    total = sum(counts.values())
    return {cell: math.sqrt(n / total) for cell, n in counts.items()}


def language_of(text, model):
    """The label and belief by the families' and pairs' weights, vote by vote."""
    import math

    features = language_features(text)
    if not features:
        return "und", 0.0

    def chance(task):
        margin = sum(float(model["weights"][task][cell]) * x for cell, x in features.items())
        return 1 / (1 + math.exp(-3 * max(-20, min(20, margin))))

    families = model["families"]
    alone = len(families) == 1
    sure = {f: 1.0 if alone else chance(f"f:{f}") for f in families}
    family = max(families, key=lambda f: sure[f])
    members = families[family]
    votes, belief = {m: 0 for m in members}, {m: 0.0 for m in members}
    for i, a in enumerate(members):
        for b in members[i + 1 :]:
            for_a = chance(f"p:{a}:{b}")
            votes[a if for_a >= 0.5 else b] += 1
            belief[a] += for_a
            belief[b] += 1 - for_a
    best = max(members, key=lambda m: (votes[m], belief[m]))
    return best, sure[family] * (belief[best] / (len(members) - 1) if len(members) > 1 else 1.0)
