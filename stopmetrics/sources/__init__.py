"""Readers of stop events and of the listing pages that announce them."""
