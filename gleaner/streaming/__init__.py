"""gleaner.streaming"""
