"""Word lists and character tables that steer the text functions."""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---- Fixed values: they must stay as they are for results to match. --------

# Short vowel marks U+064B..U+065F, the superscript alef and the tatweel.
DIACRITICS = "".join(chr(c) for c in range(0x064B, 0x0660)) + "ٰ"
TATWEEL = "ـ"

# Letter variants and the letter each becomes.
FOLD_FROM = "إأآىؤئة"
FOLD_TO = "ااايويه"

# Characters that survive cleaning, as the body of a regex class.
ARABIC_BLOCK = "؀-ۿ"

STOP_WORDS = (
    "في", "من", "على", "إلى", "عن", "أن", "إن", "كان", "كانت", "هو", "هي",
    "هذا", "هذه", "ذلك", "تلك", "ما", "لا", "لم", "لن", "قد", "كل", "كما",
    "مع", "أو", "أي", "بين", "بعد", "قبل", "التي", "الذي", "الذين", "و",
    "ف", "ب", "ل", "ك",
)

# The live-text list holds this word as well.
STREAM_STOP_WORDS = (*STOP_WORDS, "الى")

PREPOSITIONS = (
    "من", "الى", "إلى", "عن", "على", "في", "ب", "ل", "ك",
    "حتى", "منذ", "مذ", "رب", "عدا", "خلا", "حاشا",
)

FIRST_PERSON = (
    "انا", "أنا", "نحن", "لي", "لنا", "عندي", "لدينا",
    "اكتب", "نكتب", "ارى", "أرى", "نرى", "اعتقد", "أعتقد",
    "نعتقد", "اقوم", "أقوم", "نقوم",
)

ENTITY_MARKERS = (
    "جامعه", "جامعة", "وزاره", "وزارة", "مؤسسه", "مؤسسة",
    "شركه", "شركة", "مركز", "معهد", "النظام", "الدوله", "الدولة",
)

QUESTION_MARKS = "?؟"

# ---- End of fixed values. ---------------------------------------------------


@dataclass(frozen=True)
class LanguageProfile:
    """Everything language specific that the text functions need."""

    name: str
    fold_from: str
    fold_to: str
    dropped: str
    kept_class: str
    stop_words: tuple[str, ...]
    prepositions: tuple[str, ...]
    first_person: tuple[str, ...]
    entity_markers: tuple[str, ...]
    question_marks: str = QUESTION_MARKS

    def fold(self, word: str) -> str:
        """The spelling of one lexicon word after the profile's own cleaning."""
        table = dict(zip(map(ord, self.fold_from), self.fold_to))
        table.update(dict.fromkeys(map(ord, self.dropped)))
        return word.translate(table)

    def folded(self) -> LanguageProfile:
        """The same profile with every list spelled as cleaned text spells it.

        The default lists contain spellings that cleaning removes, so those
        entries can never match; folding the lists makes them reachable.
        """
        lists = ("stop_words", "prepositions", "first_person", "entity_markers")
        return replace(
            self,
            **{k: tuple(dict.fromkeys(map(self.fold, getattr(self, k)))) for k in lists},
        )

    def keeping(self, chars: str) -> LanguageProfile:
        """The same profile whose cleaning also keeps ``chars``."""
        escaped = "".join("\\" + c if c in "\\]^-[&" else c for c in chars)
        return replace(self, kept_class=self.kept_class + escaped)


ARABIC = LanguageProfile(
    name="arabic",
    fold_from=FOLD_FROM,
    fold_to=FOLD_TO,
    dropped=DIACRITICS + TATWEEL,
    kept_class=ARABIC_BLOCK,
    stop_words=STOP_WORDS,
    prepositions=PREPOSITIONS,
    first_person=FIRST_PERSON,
    entity_markers=ENTITY_MARKERS,
)

# Live text keeps the Latin question mark and has the longer stop list.
ARABIC_STREAM = replace(ARABIC.keeping("?"), name="arabic_stream", stop_words=STREAM_STOP_WORDS)

# Lower-cased Latin text: shows that the functions are not tied to one script.
LATIN = LanguageProfile(
    name="latin",
    fold_from="ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    fold_to="abcdefghijklmnopqrstuvwxyz",
    dropped="",
    kept_class="a-zÀ-ɏ",
    stop_words=(),
    prepositions=(),
    first_person=(),
    entity_markers=(),
)
