"""Set-based operators over DataFrames."""
