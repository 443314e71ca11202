import hashlib
from collections import defaultdict

from cases import ODD, UPPER
from tillroll.llm.line_dedup import dedup_lines

WHITE = " \t\n\x0b\x0c\r"


def brute(rows):
    holders = defaultdict(set)
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders[line.strip(WHITE).translate(UPPER)].add(doc)
    order = lambda d: (d is not None, d or 0)
    out = []
    for doc, text, *_ in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            key = line.strip(WHITE).translate(UPPER)
            docs = holders[key]
            if len(key) < 20 or len(docs) < 3 or max(docs, key=order) == doc:
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def key(row):
    return tuple((x is not None, x if x is not None else 0) for x in row)


def test_odd_documents(odd):
    got = sorted((tuple(r) for r in dedup_lines(odd).collect()), key=key)
    assert got == sorted(brute(ODD), key=key)
    assert sum(r[2] for r in got) > 0


def test_empty_table(none):
    assert dedup_lines(none).count() == 0


def test_positions_of_kept_lines(documents_of):
    line = "a line that is long enough to count"
    rows = [(i, f"{i}\n{line}\n\n{line}\nend {i}", "en", "a") for i in range(4)]
    kept = {r.doc_id: r.kept for r in dedup_lines(documents_of(rows)).collect()}
    assert kept[3] == rows[3][1]
    assert kept[0] == "0\n\nend 0"
    assert hashlib.sha256(kept[0].encode()).hexdigest()
