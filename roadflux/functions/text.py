"""Zone names and labels: safe spelling, repair of damaged text, one canonical key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from roadflux.functions.rules import first_match

DAMAGED = "�"  # what a lost accent turns into

# Names that damaged or unaccented spellings stand for.
LIKE_REPAIRS = [
    ("%P%riph%rie_Nord%", "Périphérie_Nord"),
    ("%P%riph%rie_Sud%", "Périphérie_Sud"),
    ("%Quartier_R%sidentiel%", "Quartier_Résidentiel"),
]
SUSPICIOUS = [f"%{DAMAGED}%", "%P%riph%", "%Quartier_R%"]
EXACT_REPAIRS = {
    "P�riph�rie_Nord": "Périphérie_Nord",
    "P�riph�rie_Sud": "Périphérie_Sud",
    "Quartier_R�sidentiel": "Quartier_Résidentiel",
}
CANONICAL = {
    "Peripherie_Nord": "Périphérie_Nord",
    "Peripherie_Sud": "Périphérie_Sud",
    "Quartier_Residentiel": "Quartier_Résidentiel",
}


def path_safe(zone: Column) -> Column:
    return F.translate(zone, " -", "__")


def restore_accents(text: Column) -> Column:
    return F.replace(text, F.lit(DAMAGED), F.lit("é"))


def _any_like(text: Column, patterns: list[str]) -> Column:
    hit = text.like(patterns[0])
    for pattern in patterns[1:]:
        hit = hit | text.like(pattern)
    return hit


def repair_zone_by_pattern(zone: Column) -> Column:
    """Rewrite only suspicious names; ``_`` in a pattern stands for any character."""
    chain = F.when(~_any_like(zone, SUSPICIOUS), zone)
    for pattern, name in LIKE_REPAIRS:
        chain = chain.when(zone.like(pattern), F.lit(name))
    return chain.otherwise(restore_accents(zone))


def repair_zone_exactly(zone: Column) -> Column:
    chain = None
    for damaged, name in EXACT_REPAIRS.items():
        chain = (F if chain is None else chain).when(zone == damaged, F.lit(name))
    return chain.otherwise(zone)


def canonical_zone(zone: Column) -> Column:
    """One key for the hyphenated, the unaccented and the damaged spelling."""
    name = restore_accents(path_safe(zone))
    chain = None
    for spelling, key in CANONICAL.items():
        chain = (F if chain is None else chain).when(name == spelling, F.lit(key))
    return chain.otherwise(name)


def repair_congestion_label(label: Column) -> Column:
    """Only labels that look damaged or already match are touched."""
    damaged = _any_like(label, [f"%{DAMAGED}%", "%lev%", "%Mod%"])
    fixed = first_match([(label.like("%lev%"), "Élevé"), (label.like("%Mod%"), "Modéré")], "Faible")
    return F.when(damaged, fixed).otherwise(label)


def repair_traffic_label(label: Column) -> Column:
    """Any label holding the UTF-8 bytes of a capital E acute becomes ``Élevé``."""
    bytes_hit = F.hex(F.encode(label, "UTF-8")).contains("C389")
    return F.when(label.like("%lev%") | bytes_hit, F.lit("Élevé")).otherwise(label)
