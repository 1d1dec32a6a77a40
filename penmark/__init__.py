"""Human-versus-machine text analytics as Spark jobs."""

from penmark.functions.lexicon import ARABIC, ARABIC_STREAM, LanguageProfile

__all__ = ["ARABIC", "ARABIC_STREAM", "LanguageProfile"]
