"""Lending and credit-bureau analytics as plain DataFrame functions."""
