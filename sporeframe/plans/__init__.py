"""sporeframe.plans"""
