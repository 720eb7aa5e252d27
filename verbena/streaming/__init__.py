"""verbena.streaming"""
