"""The order-dependent merges one after another, in one process."""

import pandas as pd

from corvine.functions.text import text_distance


class _Sets:
    """Union-find over a few ids that knows each set's seasons."""

    def __init__(self, seasons: dict[int, str]):
        self.up = {i: i for i in seasons}
        self.seasons = {i: {s} for i, s in seasons.items()}

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def merge(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            a, b = min(a, b), max(a, b)
            self.up[b] = a
            self.seasons[a] |= self.seasons.pop(b)

    def merge_apart(self, a: int, b: int) -> None:
        """Merges only sets without a common season."""
        x, y = self.find(a), self.find(b)
        if x != y and not self.seasons[x] & self.seasons[y]:
            self.merge(x, y)

    def one(self, ids: list[int]) -> bool:
        return len({self.find(i) for i in ids}) <= 1


def replay_text_merges(members: pd.DataFrame, codes: pd.DataFrame, changes: dict[str, str], exact_only: list[str], most: float) -> dict[int, int]:
    """Labels after merging courses of one code by similar titles, then by equal or similar descriptions.

    Merges are refused between sets that share a season, so their order counts: codes ascending; within a code
    pairs of distinct texts ascending. members: course_id, season_code, title, description, label; codes: course_id,
    code, course_code, ordinal.
    """
    rows = {r.course_id: r for r in members.itertuples()}
    sets = _Sets({i: r.season_code for i, r in rows.items()})
    for _, same in members.groupby("label"):
        ids = same["course_id"].tolist()
        for i in ids[1:]:
            sets.merge(ids[0], i)
    codes = codes.sort_values("ordinal")
    by_raw = codes.groupby("course_code")["course_id"].apply(list).to_dict()

    def by_text(ids: list[int], field: str) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        for i in ids:
            text = getattr(rows[i], field)
            if text is not None:
                out.setdefault(text, []).append(i)
        return dict(sorted(out.items()))

    def similar(texts: dict[str, list[int]]) -> None:
        groups = list(texts.items())
        for n, (a, first) in enumerate(groups):
            for b, second in groups[n + 1 :]:
                if sets.find(first[0]) != sets.find(second[0]) and text_distance(a, b, most) >= 0:
                    sets.merge_apart(first[0], second[0])

    for code, group in codes.groupby("code", sort=True):
        ids = group["course_id"].tolist() + by_raw.get(changes.get(code, ""), [])
        if code in exact_only or sets.one(ids):
            continue
        similar(by_text(ids, "title"))
        if sets.one(ids):
            continue
        texts = by_text(ids, "description")
        for same in texts.values():
            for a, b in zip(same, same[1:], strict=False):
                sets.merge_apart(a, b)
        if not sets.one(ids):
            similar(texts)
    return {i: sets.find(i) for i in rows}
