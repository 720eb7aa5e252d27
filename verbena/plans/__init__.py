"""verbena.plans"""
