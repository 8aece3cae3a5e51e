"""The same answers in plain Python, for small inputs."""

import hashlib
from collections import Counter, defaultdict
from datetime import datetime


def parsed(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def sessions(actions, profiles):
    """Session records joined to profiles, as dicts."""
    grouped = defaultdict(list)
    for row in actions:
        grouped[row[2]].append(row)
    found = []
    for session, rows in grouped.items():
        times = [parsed(row[4]) for row in rows]
        user = min((row[1] for row in rows if row[1] != -1), default=-1)
        for profile in profiles:
            if profile[0] == user:
                found.append(
                    {
                        "sessionid": session,
                        "searchKeywords": ",".join(sorted({r[5] for r in rows if r[5]})),
                        "clickCategoryIds": ",".join(
                            str(c) for c in sorted({r[6] for r in rows if r[6] != -1})
                        ),
                        "visitLength": int((max(times) - min(times)).total_seconds()),
                        "stepLength": len(rows),
                        "startTime": min(times).strftime("%Y-%m-%d %H:%M:%S"),
                        "age": profile[3],
                        "professional": profile[4],
                        "sex": profile[6],
                        "city": profile[5],
                    }
                )
    return found


def drawn(records, seed, size):
    """Session ids of the sample, once per drawn row."""
    hours = defaultdict(list)
    for record in records:
        hours[record["startTime"][:13]].append(record["sessionid"])
    days = Counter()
    for hour, ids in hours.items():
        days[hour[:10]] += len(ids)
    per_day = size // len(days)
    picked = []
    for hour, ids in hours.items():
        quota = min(int(len(ids) / days[hour[:10]] * per_day), len(ids))
        ids.sort(key=lambda s: (hashlib.md5(f"{s}|{seed}".encode()).hexdigest(), s))
        picked += ids[:quota]
    return sorted(picked)


def category_counts(actions, kept):
    """{category: Counter of clicks, orders, pays} and clicks per (category, session)."""
    totals, clicks = defaultdict(Counter), Counter()
    for row in actions:
        if row[2] not in kept:
            continue
        if row[6] != -1:
            totals[row[6]]["clicks"] += 1
            clicks[row[6], row[2]] += 1
        for kind, ids in (("orders", row[8]), ("pays", row[10])):
            for item in ids.split(",") if ids else []:
                totals[int(item)][kind] += 1
    return totals, clicks


def convert_rates(actions, flow):
    paths = defaultdict(list)
    for row in actions:
        paths[row[2]].append((parsed(row[4]), row[3]))
    visits, moves = Counter(), Counter()
    for path in paths.values():
        path.sort()
        pages = [page for _, page in path]
        visits.update(pages)
        moves.update(zip(pages, pages[1:]))
    rates = {}
    for a, b in zip(flow, flow[1:]):
        n = max(visits[a], 1)
        rates[f"{a}_{b}"] = ((200 * moves[a, b] + n) // (2 * n)) / 100
    return rates
