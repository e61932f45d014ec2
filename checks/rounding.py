"""How doubles are rounded before they are compared: beyond any real difference, short of accumulated noise.

Means of the two-decimal test values are decimals that often end exactly halfway between two roundings, where the order of
a sum decides. Both sides therefore add the same 0.17 of the last digit first: endings of such means (multiples of 1/2,
1/4, 1/8, ... of a digit) then never lie on the boundary.
"""


def digits(name: str) -> int:
    if name == "ds_quality_score":  # about 14,400
        return 6
    # divided by a deviation: more noise
    if name == "sd" or name.startswith(("z_", "normalized_")) or name.endswith("_popularity_score"):
        return 8
    return 10


def offset(name: str) -> float:
    return float(f"0.17e-{digits(name)}")
