"""kinveil.sources"""
