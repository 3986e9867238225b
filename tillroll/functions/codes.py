"""Score codes to segments, segments to labels and macro segments."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNCLASSIFIED = "Unclassified"
UNCLASSIFIED_LABEL = "Z.UNCLASSIFIED"

# The three-digit codes (recency, frequency, monetary score) of each segment.
SEGMENT_CODES = {
    "Champions": "555 554 544 545 454 455 445",
    "Loyal Customers": "543 444 435 355 354 345 344 335",
    "Potential Loyalist": (
        "553 551 552 541 542 533 532 531 452 451 442 441 "
        "431 453 433 432 423 353 352 351 342 341 333 323"
    ),
    "Recent Customers": "512 511 422 421 412 411 311",
    "Promising": "525 524 523 522 521 515 514 513 425 424 413 414 415 315 314 313",
    "Need Attention": "535 534 443 434 343 334 325 324",
    "About to Sleep": "331 321 312 221 213 231 241 251",
    "At Risk": (
        "255 254 245 244 253 252 243 242 235 234 225 "
        "224 153 152 145 143 142 135 134 133 125 124"
    ),
    "Cannot Lose Them": "155 154 144 214 215 115 114 113",
    "Hibernating": "332 322 233 232 223 222 132 123 122 212 211",
    "Lost": "111 112 121 131 141 151",
}

# Display label and macro segment of each segment.
SEGMENT_LABELS = {
    "Champions": "A.CHAMPIONS",
    "Loyal Customers": "B.LOYAL",
    "Potential Loyalist": "C.POTENTIAL_LOYALIST",
    "Recent Customers": "D.RECENT_CUSTOMERS",
    "Promising": "E.PROMISING",
    "Need Attention": "F.NEED_ATTENTION",
    "About to Sleep": "G.ABOUT_TO_SLEEP",
    "At Risk": "H.AT_RISK",
    "Cannot Lose Them": "I.CANNOT_LOSE",
    "Hibernating": "J.HIBERNATING",
    "Lost": "K.LOST",
}
MACRO_SEGMENTS = {
    "A.LOYAL": ("Champions", "Loyal Customers", "Potential Loyalist"),
    "B.PROMISING": ("Recent Customers", "Promising", "Need Attention"),
    "C.SLEEP": ("About to Sleep", "At Risk", "Cannot Lose Them"),
    "D.LOST": ("Hibernating", "Lost"),
}

CODE_SEGMENT = {
    code: segment for segment, codes in SEGMENT_CODES.items() for code in codes.split()
}
SEGMENT_MACRO = {
    segment: macro for macro, segments in MACRO_SEGMENTS.items() for segment in segments
}
SCORES = range(1, 6)


def segment_of(r: Column, f: Column, m: Column) -> Column:
    """Segment of a score triple: one lookup in a constant array, not a 125-branch chain."""
    by_position = F.array(
        *[
            F.lit(CODE_SEGMENT.get(f"{a}{b}{c}", UNCLASSIFIED))
            for a in SCORES
            for b in SCORES
            for c in SCORES
        ]
    )
    known = r.between(1, 5) & f.between(1, 5) & m.between(1, 5)
    position = (r - 1) * 25 + (f - 1) * 5 + m
    return F.when(known, F.element_at(by_position, position.cast("int"))).otherwise(UNCLASSIFIED)


def _choose(column: Column, mapping: dict[str, str], default: Column) -> Column:
    chain = None
    for key, value in mapping.items():
        test = column == key
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain.otherwise(default)


def label_of(segment: Column) -> Column:
    return _choose(segment, SEGMENT_LABELS, F.lit(UNCLASSIFIED_LABEL))


def label_or_same(segment: Column) -> Column:
    """As ``label_of`` but a name outside the list is kept as it is."""
    return _choose(segment, SEGMENT_LABELS, segment)


def macro_of(segment: Column) -> Column:
    return _choose(segment, SEGMENT_MACRO, F.lit(UNCLASSIFIED_LABEL))
