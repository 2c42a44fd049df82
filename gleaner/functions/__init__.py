"""gleaner.functions"""
