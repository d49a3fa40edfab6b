"""The rules once more in plain Python, for comparison on small tables."""

import math
from collections import defaultdict
from itertools import groupby


def starts(rows, key, time, marker):
    """Start of the sample of every row (by index): latest marker time at or before it."""
    out = [None] * len(rows)
    groups = defaultdict(list)
    for i, row in enumerate(rows):
        groups[key(row)].append(i)
    for members in groups.values():
        members.sort(key=lambda i: (time(rows[i]) is not None, time(rows[i]) or ""))
        current = None
        for _, peers in groupby(members, key=lambda i: time(rows[i])):
            peers = list(peers)
            if any(marker(rows[i]) for i in peers):
                current = time(rows[peers[0]])
            for i in peers:
                out[i] = current
    return out


def number(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return 0.0


def model_of(mcid):
    return mcid.split("#")[0].replace(" ", "")


def verdicts(raw, templates):
    """raw: (linenmb, eq, mc, time, leadx, leady, padx, pady); templates: model -> rows."""
    raw = [r for r in raw if r[0] > 0]
    begin = starts(raw, lambda r: (r[1], r[2]), lambda r: r[3], lambda r: r[0] == 1)
    samples = defaultdict(set)
    for row, start in zip(raw, begin):
        samples[row[1], row[2], start].add((row[0], *map(number, row[4:8])))
    out = []
    for (eq, mc, start), lines in samples.items():
        model = sorted(templates.get(model_of(mc), []))
        lines = sorted(lines)
        if not model or len(lines) > len(model):
            continue
        if len(lines) < len(model):
            out.append((eq, mc, start, 2, f"少线: 【实际/标准: {len(lines)}/{len(model)}】"))
            continue
        texts = []
        for pos, (line, wanted) in enumerate(zip(lines, model)):
            if pos == 0:
                shown, lead, pad = 1, 0.0, 0.0
            else:
                before = lines[pos - 1]
                shown = line[0]
                lead = math.sqrt((line[1] - before[1]) ** 2 + (line[2] - before[2]) ** 2)
                pad = math.sqrt((line[3] - before[3]) ** 2 + (line[4] - before[4]) ** 2)
            lead, pad = abs(wanted[1] - lead), abs(wanted[2] - pad)
            if lead > wanted[3] or pad > wanted[4]:
                texts.append(f"lineNmb{shown}_leadOffset_{lead:.2f}_padOffset_{pad:.2f}")
        out.append((eq, mc, start, 1 if texts else 0, "|".join(texts) or "qualified"))
    return out
