"""sporeframe.sources"""
