"""Declarative description of a questionnaire.

Everything downstream (typing, quality checks, reverse coding, scores, profiles)
is generated from an :class:`Instrument`, so another questionnaire needs another
value of this class and no new code.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Item:
    id: str
    text: str
    reversed: bool = False


@dataclass(frozen=True)
class Trait:
    label: str
    slug: str
    items: tuple[Item, ...]

    @property
    def score_column(self) -> str:
        return f"escore_{self.slug}"

    @property
    def flag_column(self) -> str:
        return f"elevado_{self.slug}"

    @property
    def item_ids(self) -> list[str]:
        return [i.id for i in self.items]


@dataclass(frozen=True)
class Instrument:
    """Traits with their items, the answer scale and the label dictionaries.

    ``lo..hi`` is the valid answer range and ``missing`` the code for "not
    answered". ``context`` are the other raw columns: ``place`` names the one that says
    where an answer came from, ``origin`` the one with the route code; either may be
    none of them. ``profile_labels[b]`` names the combination whose bits are set in
    ``b``; the first trait owns the highest bit. Without labels they are made of the
    trait labels.
    """

    traits: tuple[Trait, ...]
    lo: int = 1
    hi: int = 5
    missing: int = 0
    context: tuple[str, ...] = ("country", "source")
    place: str | None = "country"
    origin: str | None = "source"
    origin_labels: dict[int, str] = field(default_factory=dict)
    origin_default: str = ""
    profile_labels: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        k = len(self.traits)
        if not self.profile_labels:
            sets = [[t.label for i, t in enumerate(self.traits) if code >> (k - 1 - i) & 1] for code in range(1 << k)]
            object.__setattr__(self, "profile_labels", tuple(" + ".join(s) or "–" for s in sets))
        if len(self.profile_labels) != 1 << k:
            raise ValueError(f"{k} traits need {1 << k} profile labels, not {len(self.profile_labels)}")

    @property
    def item_ids(self) -> list[str]:
        return [i for t in self.traits for i in t.item_ids]

    @property
    def reversed_ids(self) -> frozenset[str]:
        return frozenset(i.id for t in self.traits for i in t.items if i.reversed)

    @property
    def midpoint(self) -> float:
        return (self.lo + self.hi) / 2

    @property
    def raw_columns(self) -> list[str]:
        return [*self.item_ids, *self.context]

    @property
    def score_columns(self) -> list[str]:
        return [t.score_column for t in self.traits]

    @property
    def flag_columns(self) -> list[str]:
        return [t.flag_column for t in self.traits]


# Item texts, reversed items, label dictionaries. They must equal
# the published questionnaire and its data catalogue for results to agree.
SHORT_FORM_27 = Instrument(
    traits=(
        Trait(
            "Maquiavelismo",
            "maquiavelismo",
            (
                Item("M1", "It's not wise to tell your secrets."),
                Item("M2", "I like to use clever manipulation to get my way."),
                Item("M3", "Whatever it takes, you must get the important people on your side."),
                Item("M4", "Avoid direct conflict with others because they may be useful in the future."),
                Item("M5", "It's wise to keep track of information that you can use against people later."),
                Item("M6", "You should wait for the right time to get back at people."),
                Item("M7", "There are things you should hide from other people because they don't need to know."),
                Item("M8", "Make sure your plans benefit you, not others."),
                Item("M9", "Most people can be manipulated."),
            ),
        ),
        Trait(
            "Narcisismo",
            "narcisismo",
            (
                Item("N1", "People see me as a natural leader."),
                Item("N2", "I hate being the center of attention.", reversed=True),
                Item("N3", "Many group activities tend to be dull without me."),
                Item("N4", "I know that I am special because everyone keeps telling me so."),
                Item("N5", "I like to get acquainted with important people."),
                Item("N6", "I feel embarrassed if someone compliments me.", reversed=True),
                Item("N7", "I have been compared to famous people."),
                Item("N8", "I am an average person.", reversed=True),
                Item("N9", "I insist on getting the respect I deserve."),
            ),
        ),
        Trait(
            "Psicopatia",
            "psicopatia",
            (
                Item("P1", "I like to get revenge on authorities."),
                Item("P2", "I avoid dangerous situations.", reversed=True),
                Item("P3", "Payback needs to be quick and nasty."),
                Item("P4", "People often say I'm out of control."),
                Item("P5", "It's true that I can be mean to others."),
                Item("P6", "People who mess with me always regret it."),
                Item("P7", "I have never gotten into trouble with the law.", reversed=True),
                Item("P8", "I enjoy having sex with people I hardly know."),
                Item("P9", "I'll say anything to get what I want."),
            ),
        ),
    ),
    origin_labels={1: "Página inicial do site", 2: "Busca no Google", 3: "Outra origem"},
    origin_default="Não identificada",
    profile_labels=(
        "Nenhum traço elevado",
        "Apenas psicopatia",
        "Apenas narcisismo",
        "Narcisismo + psicopatia",
        "Apenas maquiavelismo",
        "Maquiavelismo + psicopatia",
        "Maquiavelismo + narcisismo",
        "Tríade completa",
    ),
)
