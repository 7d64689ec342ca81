"""Column expressions (F1-F14, P1-P4, P12).  All JVM-side, no Python UDFs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchstats import config as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


# --- P1 / P2 ---------------------------------------------------------------

def is_incomplete(home_score="home_score", away_score="away_score") -> Column:
    """A match without both scores is incomplete; never imputed."""
    return _col(home_score).isNull() | _col(away_score).isNull()


def result_label(home_goals="home_goals", away_goals="away_goals") -> Column:
    """home_win / draw / away_win; NULL when a score is missing."""
    h, a = _col(home_goals), _col(away_goals)
    return (F.when(h > a, F.lit("home_win"))
            .when(h == a, F.lit("draw"))
            .when(h < a, F.lit("away_win")))


# --- P3 / P4 / P12 / F14 --------------------------------------------------

_ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñç"
_PLAIN = "aaaaaaeeeeiiiiooooouuuunc"


def tournament_tier(tournament="tournament", fold_accents: bool = False) -> Column:
    """Tier 1 if any tier-1 pattern and no 'qualif'; else tier 2 on any
    tier-2 pattern; else 3 (NULL -> 3).  Plain substring tests on lower().

    By default accents are kept, as in the reference ('Copa América' does
    not contain 'copa america' and is tier 3); ``fold_accents=True`` maps
    accented letters to plain ones first."""
    t = F.lower(_col(tournament))
    if fold_accents:
        t = F.translate(t, _ACCENTED, _PLAIN)
    tier1 = any_of([t.contains(k) for k in C.TIER1_KEYWORDS]) & ~t.contains(C.TIER1_BLOCKER)
    tier2 = any_of([t.contains(k) for k in C.TIER2_KEYWORDS])
    return (F.when(t.isNull(), F.lit(3))
            .when(tier1, F.lit(1))
            .when(tier2, F.lit(2))
            .otherwise(F.lit(3)))


def match_weight(tier="tournament_tier") -> Column:
    """Tier -> weight via a literal map."""
    m = F.create_map(*[x for k, v in C.TIER_WEIGHTS.items() for x in (F.lit(k), F.lit(v))])
    return m[_col(tier)]


def is_knockout(tournament="tournament") -> Column:
    """1 if the lower-case name contains a knockout keyword; NULL -> 0."""
    t = F.lower(_col(tournament))
    return F.when(t.isNull(), F.lit(0)).otherwise(
        any_of([t.contains(k) for k in C.KNOCKOUT_KEYWORDS]).cast("int"))


# --- F1 / F2 / F13 ----------------------------------------------------------

def decade(date="date") -> Column:
    """Integer decade (year // 10) * 10."""
    return (F.floor(F.year(_col(date)) / 10) * 10).cast("int")


def decade_label(date="date") -> Column:
    """'1990s'."""
    return F.concat(decade(date).cast("string"), F.lit("s"))


def days_between(d1, d2) -> Column:
    """absolute day difference; NULL if either side is NULL."""
    return F.abs(F.datediff(_col(d2), _col(d1)))


def display_date(date="date") -> Column:
    """'%d %b %Y' formatting, e.g. '05 Mar 1998'."""
    return F.date_format(_col(date), "dd MMM yyyy")


# --- F3-F8 -------------------------------------------------------------------

def team_result(result="result", is_home="is_home") -> Column:
    """Result from one side's perspective: win / draw / loss (NULL stays NULL)."""
    r, h = _col(result), _col(is_home)
    return (F.when(r == "draw", F.lit("draw"))
            .when(((r == "home_win") & h) | ((r == "away_win") & ~h), F.lit("win"))
            .when(r.isNotNull(), F.lit("loss")))


def points(result="result", is_home="is_home") -> Column:
    """3 / 1 / 0 points for a result seen from one side (NULL result -> 0)."""
    r, h = _col(result), _col(is_home)
    return (F.when(r == "draw", F.lit(C.DRAW_POINTS))
            .when(((r == "home_win") & h) | ((r == "away_win") & ~h), F.lit(C.WIN_POINTS))
            .otherwise(F.lit(C.LOSS_POINTS)))


def safe_divide(num, den, default: float = 0.0) -> Column:
    """num / den, ``default`` when den is 0 or NULL."""
    n, d = _col(num), _col(den)
    return F.when(d.isNull() | (d == 0), F.lit(float(default))).otherwise(n.cast("double") / d)


def log_experience(n) -> Column:
    """ln(max(n, 0) + 1)."""
    return F.log1p(F.greatest(_col(n).cast("double"), F.lit(0.0)))


def normalise_points(pts, n, win_points: int = C.WIN_POINTS) -> Column:
    """points / (n * win_points), 0 when n == 0."""
    return safe_divide(pts, _col(n) * F.lit(win_points))


def encode_result(result="result") -> Column:
    """home_win/draw/away_win -> 0/1/2; any other value raises."""
    r = _col(result)
    expr = F.raise_error(F.concat(F.lit("Unknown result '"), F.coalesce(r, F.lit("NULL")), F.lit("'")))
    for i, name in reversed(list(enumerate(C.RESULT_CLASSES))):
        expr = F.when(r == name, F.lit(i)).otherwise(expr)
    return expr.cast("int")


def decode_result(label="label") -> Column:
    """F8: 0/1/2 -> label string, 'unknown' otherwise."""
    m = F.create_map(*[x for i, name in enumerate(C.RESULT_CLASSES) for x in (F.lit(i), F.lit(name))])
    return F.coalesce(m[_col(label).cast("int")], F.lit("unknown"))


# --- F9 ------------------------------------------------------------------------

def _pct1(c: Column) -> Column:
    return F.concat(F.format_number(c * 100.0, 1), F.lit("%"))


def format_prediction(p_home="p_home", p_draw="p_draw", p_away="p_away",
                      home_team="home_team", away_team="away_team") -> dict[str, Column]:
    """rounded probabilities, predicted outcome (ties: home, away, draw),
    predicted winner, confidence band and a summary sentence."""
    ph, pd_, pa = _col(p_home), _col(p_draw), _col(p_away)
    mx = F.greatest(ph, pd_, pa)
    predicted = (F.when(mx == ph, F.lit("home_win"))
                 .when(mx == pa, F.lit("away_win"))
                 .otherwise(F.lit("draw")))
    winner = (F.when(mx == ph, _col(home_team))
              .when(mx == pa, _col(away_team))
              .otherwise(F.lit("Draw")))
    confidence = (F.when(mx >= C.CONFIDENCE_HIGH, F.lit("High"))
                  .when(mx >= C.CONFIDENCE_MEDIUM, F.lit("Medium"))
                  .otherwise(F.lit("Low")))
    summary = F.concat(
        _col(home_team), F.lit(" vs "), _col(away_team), F.lit(" → "),
        _col(home_team), F.lit(" Win: "), _pct1(ph), F.lit(" | Draw: "), _pct1(pd_),
        F.lit(" | "), _col(away_team), F.lit(" Win: "), _pct1(pa),
        F.lit(" ["), confidence, F.lit(" confidence]"))
    return {
        "home_win": F.round(ph, 4),
        "draw": F.round(pd_, 4),
        "away_win": F.round(pa, 4),
        "predicted_outcome": predicted,
        "predicted_winner": winner,
        "confidence": confidence,
        "summary": summary,
    }


# --- F10 / F11 -----------------------------------------------------------------

def clip(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def attack_pct(gf="gf", played="played") -> Column:
    """clip(gf / n / 2 * 100, 0, 100), n = max(played, 1)."""
    n = F.greatest(_col(played), F.lit(1))
    return clip(_col(gf) / n / 2.0 * 100.0, 0.0, 100.0)


def defence_pct(ga="ga", played="played") -> Column:
    """clip((1 - ga / n / 2) * 100, 0, 100)."""
    n = F.greatest(_col(played), F.lit(1))
    return clip((1.0 - _col(ga) / n / 2.0) * 100.0, 0.0, 100.0)


def clean_sheet_proxy(ga="ga", played="played") -> Column:
    """(1 - ga / n / 3) * 100."""
    n = F.greatest(_col(played), F.lit(1))
    return (1.0 - _col(ga) / n / 3.0) * 100.0
