"""Writers of flight months and result tables."""
