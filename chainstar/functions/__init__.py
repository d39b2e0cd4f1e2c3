"""Column -> Column helpers (no DataFrames, no actions).

strings   clean, bounded, surrogate_key, default_text, any_true (P1, P6, X1-X3, F6)
epochs    is_multiple, epoch, halving_level (R9: X5-X7)
calendar  calendar_columns and its parts (C1-C28)
numeric   exact decimal arithmetic: to_units, int_mul, round_div, from_units, exact_ratio,
          safe_ratio, shift_round, scale_units (R10, X10-X12, X15)
measures  the mining-economics measures (D1-D19)
"""
