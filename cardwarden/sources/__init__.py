"""Inputs: landed JSON, the built-in sample and the bronze feed made of the test tables."""
