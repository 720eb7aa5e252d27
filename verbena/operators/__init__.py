"""verbena.operators"""
