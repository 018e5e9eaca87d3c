"""Brute-force results shared by tests."""


def expected_history(records):
    """Brute force: per key in time order, smallest state per moment, runs of equal states."""
    versions = []
    for key in {r[0] for r in records}:
        moments = {}
        for _, at, a, zones in (r for r in records if r[0] == key):
            rank = ((a is not None, a or ""), (zones is not None, zones or []))  # NULL is smallest
            moments[at] = min(moments.get(at, (rank, a, zones)), (rank, a, zones),
                              key=lambda x: x[0])
        runs = []
        for at in sorted(moments):
            _, a, zones = moments[at]
            if not runs or (runs[-1][1], runs[-1][2]) != (a, zones):
                runs.append([key, a, zones, at, None])
                if len(runs) > 1:
                    runs[-2][4] = at
        versions += [tuple(r) for r in runs]
    return sorted(versions, key=repr)
