"""Readers: flight legs, weather, monthly archives, published results."""
