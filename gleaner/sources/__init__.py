"""gleaner.sources"""
