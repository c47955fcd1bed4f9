"""Set-wise ledger operators on DataFrames (B, C, E, F, G, H, J of the operator inventory)."""
