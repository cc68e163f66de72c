"""The clock of a tier by the mass of its events, which single wrong dates do not move."""

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable
from itertools import accumulate

#: Hours that support a label, in turn: the first in which the fullest stretch has ENOUGH events.
SUPPORT_HOURS, ENOUGH = (1, 6, 24), 20
#: A label counts if its support has this share of the fullest stretch's events, and two at least.
SHARE, LEAST = 0.1, 2
#: Days that the newest label may lie after the one before it where no label has support.
LARGEST_GAP = 31


def _judge(events: dict[int, int]) -> tuple[Callable[[int], bool], int]:
    """Whether an hour has the support of these events, by hour; and those of their fullest stretch."""
    order = sorted(events)
    sums = list(accumulate((events[hour] for hour in order), initial=0))

    def stretch(hour: int, width: int) -> int:
        return sums[bisect_right(order, hour)] - sums[bisect_left(order, hour - width)]

    for width in SUPPORT_HOURS:
        fullest = max(stretch(hour, width) for hour in order)
        if fullest >= ENOUGH:
            break
    return lambda hour: stretch(hour, width) >= max(SHARE * fullest, LEAST), fullest


def trusted_label(
    hours: Iterable[tuple[int, int, int]], others: Iterable[dict[int, int]] = ()
) -> int | None:
    """The newest supported label, in seconds, from (hour since 1970, events, newest label) rows.

    A label's support are the events of its hour and of 1, 6 or 24 hours before. Some events with a
    wrong date ahead of all others have no such support, so the clock stays where the mass ends; when
    the shop comes back after a pause it waits for a tenth of the usual mass. With so few events that
    nothing has support the newest label counts, unless it lies more than LARGEST_GAP days ahead,
    which is refused. None without rows.

    `others` are the events by hour of each other event type. Each type with ENOUGH events supports
    by its own measure, and the support of one will do: views that count once run dry when all pairs
    have been seen, and then the purchases tell that the shop goes on.
    """
    events: dict[int, int] = {}
    labels: dict[int, int] = {}
    for hour, count, label in hours:
        events[hour] = events.get(hour, 0) + count
        labels[hour] = max(label, labels.get(hour, label))
    if not events:
        return None
    order = sorted(events)
    judges = [_judge(events)[0]]
    for supported, fullest in map(_judge, filter(None, others)):
        if fullest >= ENOUGH:
            judges.append(supported)
    for hour in reversed(order):
        if any(supported(hour) for supported in judges):
            return labels[hour]
    if len(order) > 1 and order[-1] - order[-2] > 24 * LARGEST_GAP:
        raise ValueError(
            f"the newest label lies {(order[-1] - order[-2]) // 24} days after the one before it:"
            " pass `now` if that is right"
        )
    return labels[order[-1]]


def trusted_clock(
    counts: Iterable[tuple[str, str, int, int, int]], event: str | None
) -> int | None:
    """trusted_label() of an event type from (event type, dimension, hour, events, newest label) rows.

    Every dimension has the same events, so the largest count of an hour is taken. Where `event` has
    no rows at all, any event's labels count.
    """
    sums: dict[tuple[str, str, int], tuple[int, int]] = {}
    for kind, dim, hour, events, last in counts:
        seen = sums.get((kind, dim, hour), (0, last))
        sums[kind, dim, hour] = seen[0] + events, max(seen[1], last)
    masses: dict[str, dict[int, tuple[int, int]]] = {}
    for (kind, _, hour), (events, last) in sums.items():
        if events > 0:
            seen = masses.setdefault(kind, {}).get(hour, (0, last))
            masses[kind][hour] = max(seen[0], events), max(seen[1], last)
    timed = [event] if event in masses else list(masses)
    rows = [(hour, *value) for kind in timed for hour, value in masses[kind].items()]
    others = [{h: n for h, (n, _) in own.items()} for kind, own in masses.items() if kind not in timed]
    return trusted_label(rows, others)
