"""kinveil.functions"""
