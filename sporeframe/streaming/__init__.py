"""sporeframe.streaming"""
