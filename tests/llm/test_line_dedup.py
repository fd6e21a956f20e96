from __future__ import annotations

import random
import re

from marketloom.llm import line_dedup
from .helpers import ODD, by_id


def brute(rows):
    order = sorted({(i is None, i or 0, t) for i, t in rows if t is not None})
    seen, gone = {}, {}
    for missing, i, t in order:
        lines = [(n, s) for n, s in enumerate(t.split("\n")) if re.search(r"[^\x20\x09-\x0D]", s)]
        own = gone.setdefault((missing, i, t), set())
        for j in range(len(lines) - 2):
            run = tuple(s for _, s in lines[j : j + 3])
            if seen.setdefault(run, (missing, i, j)) != (missing, i, j):
                visible = {n for n, _ in lines}
                own.update(n for n in range(lines[j][0], lines[j + 2][0] + 1) if n in visible)
    out = []
    for i, t in rows:
        cut = gone.get((i is None, i or 0, t), set())
        out.append((i, None if t is None else "\n".join(s for n, s in enumerate(t.split("\n")) if n not in cut), len(cut)))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_against_brute_force(docs):
    rnd = random.Random(6)
    rows = [*ODD, *((10 + i, "\n".join(rnd.choice(["a", "b", "c", "", " ", "d"]) for _ in range(rnd.randint(0, 14)))) for i in range(80))]
    rows += [(200 + i, f"head {i}\nlicence one\nlicence two\n\nlicence three\ntail {i}") for i in range(60)]
    rows += [(300, "x\ny\nz"), (300, "x\ny\nz\nz"), (None, "x\ny\nz"), (301, "a\n" * 3000), (302, "q\n" * 3)]
    frame = docs(*rows)
    got = line_dedup.without_repeats(frame)
    assert got.drop("__kept", "__n_lines", "__n_removed", "__n_stretches").columns == frame.columns
    assert by_id(got, "doc_id", "__kept", "__n_removed") == brute(rows)
    assert line_dedup.without_repeats(docs()).count() == 0


def test_no_python_on_the_main_path(docs):
    plan = line_dedup.without_repeats(docs((1, "a\nb\nc")))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
