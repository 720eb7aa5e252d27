"""verbena.sources"""
