"""Recipes composing the operators (E1-E4) and plan-inspection helpers."""
